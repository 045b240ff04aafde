"""Token ids in compressed binary blocks, one frame per document.

A file of the format is a Parquet table of blocks. A block's bytes are a header (magic, hash of the
dictionary, number of documents), an offset index (per document: its place, tokens before it in the
block, tokens of its own), then one zstandard frame per document over its ids as little-endian
unsigned 16- or 32-bit integers. All frames share one dictionary, trained on the serialized ids of a
bounded sample of documents and stored beside the blocks under its hash. A short document is read by
seeking its index entry and decompressing its frame alone.

Documents stand in ascending order of id (null ids first, repeated ids by text), the end id after
each. A null text counts as empty and holds the end id only. An empty table gives no blocks. Texts
of any length make one frame; a block closes after the document that fills it. Extra columns are
ignored.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import string
import struct
from collections.abc import Iterator
from itertools import chain, compress, islice, repeat
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import BATCH_ROWS, crc32, documents, map_batches, new_folder

END_ID = 2
MAGIC = b"CTID"
#: Bytes of frames after which a block closes.
BLOCK_BYTES = 1 << 20
#: Bytes of the dictionary, and documents at most that it is trained on.
DICTIONARY_BYTES, DICTIONARY_DOCS = 64 << 10, 2000
#: Pieces of text whose ids a worker remembers.
CACHE_PIECES = 1_000_000
LEVEL = 3

_HEADER = struct.Struct("<4sQI")
_ENTRY = np.dtype([("at", "<u4"), ("before", "<u4"), ("tokens", "<u4"), ("wide", "<u4")])
# A space between two characters that are no space begins a new piece in the byte-level split, so a
# text may be cut there and the ids of its parts joined.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Marks behind a word of letters are a piece of their own there. An apostrophe may begin one with letters.
_MARKS = string.punctuation.replace("'", "")


def byte_characters() -> str:
    """The character with which a byte-level vocabulary writes each byte: its own where that is visible."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(others)) for b in range(256))


_CHARACTERS = byte_characters()
_SPACE, _LINE = _CHARACTERS[ord(" ")], _CHARACTERS[ord("\n")]


def _for_letters(path: str):
    """Tokenizers of the library with the same model for rows of words of letters, behind spaces and in
    lines of their own, where the byte-level split does no more than cut there; they take byte
    characters. None for other kinds of tokenizers."""
    from tokenizers import Tokenizer, pre_tokenizers
    from tokenizers.models import BPE

    with open(path, encoding="utf-8") as file:
        config = json.load(file)
    model, split = config["model"], config["pre_tokenizer"] or {}
    usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not config["normalizer"]
    if not usual or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    # Every row is new, so remembering words inside the library would only cost.
    plain = BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
    behind_spaces, in_lines = Tokenizer(plain), Tokenizer(plain)
    behind_spaces.pre_tokenizer = pre_tokenizers.Split(_SPACE, "merged_with_next")
    in_lines.pre_tokenizer = pre_tokenizers.Split(_LINE, "isolated")
    return behind_spaces, in_lines


class Encoder:
    """The tokenizer, with the ids of pieces between single spaces remembered.

    A text with white space beside a space, which could join two pieces, is cut only where that is
    safe; one that holds the text of an added token is encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _for_letters(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A byte-level token is written with one character per byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.lengths = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.begins = {" ": self.lengths > 0, "\n": self.lengths > 0}  # whether a token begins with a space, is a line end
        for token, i in vocabulary.items():
            self.lengths[i], self.begins[" "][i], self.begins["\n"][i] = len(token), token[:1] == _SPACE, token == _LINE
        self.type = np.dtype("<u2" if len(self.lengths) <= 1 << 16 else "<u4")
        #: Ids of pieces by their text behind the space, or behind a NUL for the first piece of a text;
        #: None where that text is no plain piece.
        self.cache: dict[str, bytes | None] = {}
        self.line_end = self._whole(["\n"])[0].tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned integers."""
        split = [t.split(" ") for t in texts]
        for parts in split:
            parts[0] = "\0" + parts[0]
        new = set().union(*split).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_PIECES:
            # The pieces met first are the frequent ones.
            self.cache = dict(islice(self.cache.items(), CACHE_PIECES // 3))
            new = set().union(*split).difference(self.cache)
        self._learn(new)
        known, out = self.cache, []
        for text, parts in zip(texts, split):
            try:
                found = itemgetter(*parts)(known) if len(parts) > 1 else [known[parts[0]]]
                ids = np.frombuffer(b"".join(found), dtype=self.type)
            except TypeError:  # a piece that is None
                ids = self._apart(text)
            if "\0" in text or any(map(text.__contains__, self.added)):
                ids = self._apart(text)
            out.append(ids)
        return out

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.type) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, text: str) -> np.ndarray:
        """Ids of a text with unusual white space or added tokens, remembering nothing."""
        if any(a in text for a in self.added):
            return self._whole([text])[0]
        first, *rest = _CUT.split(text)
        return np.concatenate(self._whole([first, *(" " + piece for piece in rest)]))

    def _learn(self, pieces: set[str]) -> None:
        """Encodes new pieces. Where the split is known, words with marks behind them, or with the first
        word of the next line, are put together from their parts, which are far fewer."""
        words = set(filter(str.isalpha, pieces)) if self.letters else set()
        rest = pieces.difference(words)
        heads = {p for p in rest if p[:1] == "\0"}
        rest -= heads
        odd = [p for p in rest if not p or p[0].isspace() or p[-1].isspace()]
        self.cache.update(dict.fromkeys(odd))
        rest.difference_update(odd)
        # Plain lists of strings: a tuple per piece would keep the garbage collector busy.
        marked, stems, lines = [], [], []
        if self.letters:
            others = list(rest)
            stems = list(map(str.rstrip, others, repeat(_MARKS)))
            whole = list(map(str.isalpha, stems))
            marked, stems = list(compress(others, whole)), list(compress(stems, whole))
            lines = [p for p in others if "\n" in p and all(part.rstrip(_MARKS).isalpha() for part in p.split("\n", 1))]
            firsts, seconds = [p.partition("\n")[0] for p in lines], [p.partition("\n")[2] for p in lines]
            first_words, second_words = (list(map(str.rstrip, x, repeat(_MARKS))) for x in (firsts, seconds))
            # Behind a word or a line end, no space before it, a part has the ids of a text that begins with it.
            tails = {p[len(w):] for p, w in zip(chain(marked, firsts, seconds), chain(stems, first_words, second_words))}
            tails.update(second_words)
            tails.discard("")
            heads |= {"\0" + t for t in tails}.difference(self.cache)
            words.update(set(chain(stems, first_words)).difference(self.cache))
            rest.difference_update(marked, lines)
            openings = [p[1:] for p in heads if p[1:].isalpha()]
            heads.difference_update(["\0" + p for p in openings])
            self._learn_words(openings, "\n")
            self._learn_words(list(words), " ")
        for p, ids in zip(heads, self._whole([p[1:] for p in heads])):
            self.cache[p] = None if p == "\0" or p[-1].isspace() else ids.tobytes()
        self._learn_rows(list(rest))
        known = self.cache
        for p, w in zip(marked, stems):
            known[p] = known[w] + known["\0" + p[len(w):]]
        marks = lambda part, w: b"" if part == w else known["\0" + part[len(w):]]
        for p in lines:
            first, _, second = p.partition("\n")
            w, v = first.rstrip(_MARKS), second.rstrip(_MARKS)
            known[p] = known[w] + marks(first, w) + self.line_end + known["\0" + v] + marks(second, v)

    def _learn_words(self, words: list[str], before: str) -> None:
        """Encodes words of letters behind a space, or at the beginning of a line, many in a row. A word
        begins where a token begins with a space, or behind the token of a line end."""
        line = before == "\n"
        rows = [words[i:i + 1000] for i in range(0, len(words), 1000)]
        texts = [codecs.charmap_decode((before + before.join(r)).encode(), "strict", _CHARACTERS)[0] for r in rows]
        encoded = self.letters[line].encode_batch_fast(texts, add_special_tokens=False)
        size, begins, name = self.type.itemsize, self.begins[before], "\0" if line else ""
        for row, encoding in zip(rows, encoded):
            names = [name + p for p in row] if line else row
            ids = np.array(encoding.ids, dtype=self.type)
            starts = np.flatnonzero(begins[ids])
            if len(starts) == len(row) and starts[0] == 0:
                data, starts = ids.tobytes(), (starts * size).tolist()
                skip = size if line else 0
                self.cache.update(zip(names, [data[a + skip:b] for a, b in zip(starts, [*starts[1:], len(data)])]))
            else:
                self.cache.update(zip(names, [ids.tobytes() for ids in self._whole([p if line else " " + p for p in row])]))

    def _learn_rows(self, pieces: list[str]) -> None:
        """Encodes pieces, many in a row, and cuts the row where the bytes of its tokens add up to a piece."""
        rows = [pieces[i:i + 1000] for i in range(0, len(pieces), 1000)]
        encoded = self.tokenizer.encode_batch_fast([" " + " ".join(r) for r in rows], add_special_tokens=False)
        for row, encoding in zip(rows, encoded):
            ids = np.array(encoding.ids, dtype=np.int64)
            ends = np.cumsum(self.lengths[ids])
            wanted = np.cumsum(np.fromiter(map(len, map(str.encode, row)), dtype=np.int64, count=len(row)) + 1)
            cuts = np.searchsorted(ends, wanted) + 1
            if len(ids) and cuts[-1] == len(ids) and np.array_equal(ends[cuts - 1], wanted):
                data, size = ids.astype(self.type).tobytes(), self.type.itemsize
                stops = (cuts * size).tolist()
                self.cache.update(zip(row, [data[a:b] for a, b in zip([0, *stops], stops)]))
            else:
                self.cache.update(zip(row, [ids.tobytes() for ids in self._whole([" " + p for p in row])]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def serialized(ids: np.ndarray) -> tuple[bytes, bool]:
    """Little-endian bytes of the ids, and whether they take 32 bits."""
    wide = ids.dtype.itemsize > 2 and bool(len(ids)) and int(ids.max()) > 0xFFFF
    return ids.astype("<u4" if wide else "<u2", copy=False).tobytes(), wide


class Dictionary(NamedTuple):
    hash: int
    data: bytes

    def compressor(self) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionDict(self.data) if self.data else None
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=False, write_dict_id=False)

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(self.data) if self.data else None)


def dictionary_of(data: bytes) -> Dictionary:
    import xxhash

    return Dictionary(xxhash.xxh3_64_intdigest(data), data)


def train_dictionary(docs: DataFrame, path: str, sample: int = DICTIONARY_DOCS) -> Dictionary:
    """A dictionary from at most ``sample`` documents, drawn by a hash of id and text; empty where
    there is too little to learn from. Only the first 4,096 ids of a sampled document are used."""
    count = docs.count()
    share = min(1.0, sample / max(count, 1))
    drawn = documents(docs).where(
        F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample)

    def encode(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ids": [serialized(ids[:4096])[0] for ids in encoder(path).encode(list(batch["text"]))]})
    samples = sorted(bytes(b) for b in map_batches(drawn, encode, "ids binary").toPandas()["ids"] if b)
    try:
        data = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 50 else b""
    except zstandard.ZstdError:  # too little or too uniform data
        data = b""
    return dictionary_of(data)


class Block:
    """Documents' frames being put together."""

    def __init__(self, dictionary: Dictionary) -> None:
        self.dictionary = dictionary
        self.entries: list[tuple[int, int, int, int]] = []
        self.ids: list[int | None] = []
        self.frames: list[bytes] = []
        self.size = self.tokens = 0

    def add(self, doc_id: int | None, frame: bytes, tokens: int, wide: bool) -> None:
        self.entries.append((self.size, self.tokens, tokens, wide))
        self.ids.append(doc_id)
        self.frames.append(frame)
        self.size += len(frame)
        self.tokens += tokens

    def to_bytes(self) -> bytes:
        index = np.array([*self.entries, (self.size, self.tokens, 0, 0)], dtype=_ENTRY)
        return _HEADER.pack(MAGIC, self.dictionary.hash, len(self.ids)) + index.tobytes() + b"".join(self.frames)


class BlockReader:
    """Random access to the documents of a block."""

    def __init__(self, data: bytes, dictionary: Dictionary) -> None:
        magic, key, n = _HEADER.unpack_from(data)
        if magic != MAGIC or key != dictionary.hash:
            raise ValueError("not a block of this dictionary")
        self.data, self.n = data, n
        self.index = np.frombuffer(data, dtype=_ENTRY, count=n + 1, offset=_HEADER.size)
        frames = _HEADER.size + (n + 1) * _ENTRY.itemsize
        self.places = (self.index["at"].astype(np.int64) + frames).tolist()
        self.tokens, self.wide = self.index["tokens"].tolist(), self.index["wide"].tolist()
        self.decompressor = dictionary.decompressor()

    def document(self, i: int) -> np.ndarray:
        frame = self.data[self.places[i]:self.places[i + 1]]
        raw = self.decompressor.decompress(frame, max_output_size=self.tokens[i] * 4 + 1)
        return np.frombuffer(raw, dtype="<u4" if self.wide[i] else "<u2").astype("<u4")


_BLOCKS = "part int, block int, n_docs int, n_tokens long, doc_ids array<long>, data binary"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes ``folder/blocks``, ``folder/parts`` (tokens before each part) and ``folder/dictionary``.

    Documents are range-partitioned by id; texts are encoded after that, once.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer)
    spark.createDataFrame([(f"{dictionary.hash:016x}", dictionary.data)], "hash string, data binary").write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        press = shared.value.compressor()
        block = Block(shared.value)

        def closed() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "block": [number], "n_docs": [len(block.ids)], "n_tokens": [block.tokens],
                                 "doc_ids": [block.ids], "data": [block.to_bytes()]})
        for batch in batches:
            for start in range(0, len(batch), BATCH_ROWS):
                rows = batch.iloc[start:start + BATCH_ROWS]
                ids_of = encoder(tokenizer).encode(list(rows["text"]))
                for doc_id, ids in zip(rows["doc_id"], ids_of):
                    raw, wide = serialized(np.append(ids, ids.dtype.type(end_id)))
                    block.add(None if pd.isna(doc_id) else int(doc_id), press.compress(raw), len(ids) + 1, wide)
                    if block.size >= BLOCK_BYTES or block.tokens >= 1 << 30:
                        yield closed()
                        number += 1
                        block = Block(shared.value)
        if block.ids:
            yield closed()
    ordered = documents(docs).repartitionByRange("doc_id", F.crc32(F.col("text").cast("binary")))
    ordered = ordered.sortWithinPartitions("doc_id", F.crc32(F.col("text").cast("binary")))
    ordered.mapInPandas(blocks, _BLOCKS).write.parquet(f"{folder}/blocks")
    totals = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").select("part", "block", "n_docs", "n_tokens")
    # One row per block, thousands of documents each: running sums over them are small.
    per_part = totals.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(F.col("part").alias("p"), F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    index = totals.join(F.broadcast(offsets), F.col("part") == F.col("p")).select(
        "part", "block", (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"))
    index.write.parquet(f"{folder}/parts")


def read_dictionary(spark: SparkSession, folder: str) -> Dictionary:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    dictionary = dictionary_of(bytes(row["data"]))
    if f"{dictionary.hash:016x}" != row["hash"]:
        raise ValueError("the dictionary does not match its hash")
    return dictionary


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    index = spark.read.parquet(f"{folder}/parts").select(F.col("part").alias("p"), F.col("block").alias("b"), "start")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    # An index row is 16 bytes for a block of a megabyte or so; the optimizer decides how to join.
    return blocks.join(index, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))).drop("p", "b")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    shared = spark.sparkContext.broadcast(read_dictionary(spark, folder))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, start, doc_ids in zip(batch["data"], batch["start"], batch["doc_ids"]):
                reader = BlockReader(bytes(data), shared.value)
                crcs = [crc32(reader.document(i).tobytes()) for i in range(reader.n)]
                index = reader.index[:reader.n]
                yield pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(d) else int(d) for d in doc_ids], dtype="Int64").to_numpy(dtype=object, na_value=None),
                    "start": int(start) + index["before"].astype(np.int64),
                    "n_tokens": index["tokens"].astype(np.int64), "ids_crc32": crcs})
    return _blocks(spark, folder).select("data", "start", "doc_ids").mapInPandas(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a few documents: only their blocks are read, only their frames decompressed."""
    shared = spark.sparkContext.broadcast((read_dictionary(spark, folder), frozenset(doc_ids)))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dictionary, wanted = shared.value
        for batch in batches:
            for data, ids in zip(batch["data"], batch["doc_ids"]):
                reader = BlockReader(bytes(data), dictionary)
                hits = [(int(d), i) for i, d in enumerate(ids) if not pd.isna(d) and int(d) in wanted]
                yield pd.DataFrame({"doc_id": [d for d, _ in hits], "ids": [reader.document(i).astype(np.int64) for _, i in hits]})
    holding = F.arrays_overlap("doc_ids", F.array(*[F.lit(d).cast("long") for d in doc_ids]))
    return spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").where(holding).select("data", "doc_ids").mapInPandas(
        fetch, "doc_id long, ids array<long>")


def encoded_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents to a new shared folder and returns the digests read back from it."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    write_tokens(docs, folder, tokenizer)
    return token_digests(spark, folder)
