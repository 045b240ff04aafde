"""DuckDB SQL for the results that SQL can state whole, written from the rules and not from the operators."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _remainder(value: int, bits: int) -> int:
    """``bits`` steps of the reflected CRC-32 division."""
    for _ in range(bits):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


def crc32_sql(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes, half a byte at a time."""
    table = [_remainder(half, 4) for half in range(16)]
    step = lambda state: f"xor({state} >> 4, list_extract({table}::BIGINT[], ({state} & 15) + 1))"
    over = step(step("xor(c, b)"))
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(4294967295, list_reduce({octets}, lambda c, b: {over}, 4294967295::BIGINT))"


#: By query. The other queries have columns that only their method gives.
ORACLES: dict[str, str] = {
    "op7_partenum": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle
          FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
          FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
          SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 100 * same >= 85 * (p.n + q.n - same)),
        reached AS (
          SELECT a AS doc_id, b AS other FROM links
          UNION SELECT doc_id, b FROM reached JOIN links ON other = a)
        SELECT words.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(words.doc_id, min(other)) AS component_id
        FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN reached USING (doc_id) GROUP BY words.doc_id""",
    "op8_sharding": f"""
        WITH sized AS (
          SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
                 {crc32_sql("coalesce(text, '')")} AS text_crc32, substr(md5(coalesce(text, '')), 1, 15) AS key
          FROM documents),
        laid AS (
          SELECT *, sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start,
                 sum(size) OVER (PARTITION BY key) AS group_bytes, sum(size) OVER () / 16.0::DOUBLE AS target FROM sized),
        middles AS (
          SELECT *, CASE WHEN group_bytes <= target * 0.01::DOUBLE THEN min(start) OVER (PARTITION BY key) + group_bytes / 2
                    ELSE start + size / 2 END AS middle FROM laid),
        placed AS (SELECT *, CAST(least(floor(middle / target), 15) AS INTEGER) AS shard FROM middles)
        SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
        FROM placed""",
    "op11_columnar_topk": """
        WITH whole AS (
          SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS score
          FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 5""",
    "op13_variant_tiles": rf"""
        WITH RECURSIVE runs AS (
          SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
        hashed AS (
          SELECT run, k, {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
          FROM (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY doc_id, run)),
        words AS (
          SELECT word, CAST(sum(k) AS BIGINT) AS n
          FROM (SELECT k, CASE WHEN h % 97 <> 0 THEN run
                          ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word FROM hashed)
          WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
        shorter AS (
          SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
        near AS (
          SELECT x.word, y.word AS other, y.n FROM shorter x JOIN shorter y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
          UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
          UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word),
        best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n FROM near GROUP BY word),
        forms AS (
          SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
                 CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
          FROM words LEFT JOIN best USING (word)),
        steps AS (
          SELECT word, word AS root, form AS onward FROM forms
          UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON s.onward = f.word)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN steps USING (word) WHERE onward IS NULL""",
}
