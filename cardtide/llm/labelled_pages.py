"""Labelled pages from which the tree model of ``dom_marginals`` is trained.

Written by hand: an element with ``keep`` belongs to the article, one with ``drop`` to the frame of
the page; elements inside take the mark of the nearest marked one around them.
"""

_P = "Some longer sentence about the matter at hand, with a comma and a full stop. Another one follows it here."
_Q = "A short remark."
_MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>About</a></li></ul>"

PAGES = (
    f"""<html><head drop><title>T</title></head><body drop><nav drop>{_MENU}</nav><div class="ad" drop>Buy this now.</div>
    <article keep><h1>Title of it</h1><p>{_P}</p><p>{_Q}</p><p>{_P}<br>{_P}</p></article><footer drop>&copy; example.org &middot; {_Q}</footer></body></html>""",
    f"""<html><body drop><header drop><a href="/">Site name</a><p>Our motto for you.</p></header><nav class="menu" drop>{_MENU}</nav>
    <main keep><h1>Title of it</h1><p>{_P}</p><ul><li>First point.</li><li>Second point.</li></ul><blockquote><p>{_P}</p></blockquote><p>{_P}</p></main>
    <aside class="sidebar" drop><h3>Related</h3>{_MENU}<p>{_Q}</p></aside><footer drop><p>All about us. {_P}</p>{_MENU}</footer></body></html>""",
    f"""<html><body drop><div id="cookie-notice" class="notice" drop><p>We use cookies to improve your visit. {_P}</p><button>Accept</button></div>
    <div id="header" class="header" drop><h1>Site name</h1>{_MENU}</div><div id="content" class="post" keep><h2>Title of it</h2><p>{_P}</p>
    <div class="text"><p>{_P}</p><p>{_Q}</p></div><table><tr><td>cell text</td><td>12</td></tr></table><pre>some code here</pre></div>
    <div id="comments" class="comments" drop><h3>Comments</h3><div class="comment"><p>{_P}</p></div><div class="comment"><p>I liked it a lot.</p></div></div>
    <div id="footer" class="footer" drop><p>{_P}</p></div></body></html>""",
    f"""<html><body drop><div class="banner" drop><p>Subscribe to our letter today, it is free.</p></div><div class="navbar" drop>{_MENU}</div>
    <div class="wrapper"><div class="article-body" keep><h1>Title</h1><p>{_P}</p><h2>Part one</h2><p>{_P}</p><p>{_Q}</p><ol><li>{_Q}</li><li>{_P}</li></ol></div>
    <div class="widget sidebar" drop><h4>Popular</h4>{_MENU}<p>{_P}</p></div></div>
    <form class="subscribe" drop><p>Enter your mail to get our news.</p><label>Mail</label><input></form><div class="advert" drop><p>{_P}</p></div></body></html>""",
    f"""<html><body drop><article keep><header><h1>Title</h1><p>By someone, in May.</p></header><p>{_P}</p><div class="ad" drop>Cheap things here.</div><p>{_P}</p>
    <section><h2>More</h2><p>{_P}</p><figure><figcaption>{_Q}</figcaption></figure></section>
    <div class="share social" drop><a href="/x">Share</a><a href="/y">Post</a></div><section class="comments" drop><p>{_P}</p><p>{_Q}</p></section></article>
    <footer drop>{_P}</footer></body></html>""",
    f"""<html><body drop><div class="promo" drop><p>{_Q}</p></div><div class="breadcrumb" drop><a href="/">Home</a> &gt; <a href="/x">x</a></div>
    <div class="story" keep><h1>Title</h1><p>{_P}</p><p>{_P} <a href="/in">inner link</a> {_Q}</p><div><p>{_P}</p></div><dl><dt>term</dt><dd>{_Q}</dd></dl></div>
    <div class="alert warning" drop>{_P}</div><div class="related" drop><h3>See also</h3><p>{_P}</p>{_MENU}</div><div class="login" drop><form><p>Sign in.</p></form></div></body></html>""",
    f"""<html><body drop><section class="hero" drop><p>{_Q}</p></section><section keep><h1>Title</h1><p>{_P}</p><p>{_P}</p><p>{_Q}</p></section>
    <section class="comment-list" id="reader-comments" drop><article class="comment"><p>{_P}</p></article><article class="comment"><p>{_Q}</p></article></section>
    <aside drop><p>{_P}</p></aside><div role="navigation" class="pagination" drop><a href="/2">2</a><a href="/3">3</a></div></body></html>""",
    f"""<html><body drop><article keep><h1>Only title</h1><p><b>{_P}<br></p><p>{_Q}</p><p>One.</p><p>{_P}</p></article><div class="popup modal consent" drop><p>{_P}</p></div>
    <ul class="menu" drop><li><a href="/a">a</a></li></ul><div class="sponsored" drop><p>{_P}</p><a href="/s">more</a></div></body></html>""",
    f"""<html><body keep><p>{_P}</p><p>{_P}</p><p>{_Q}</p></body></html>""",
    f"""<html><body drop><div keep><p>{_P}</p><div>{_P}</div><p>{_Q}</p></div><div drop>{_MENU}</div></body></html>""",
    f"""<html><body drop><main><article keep><h1>Title</h1><p>{_P}</p><p>{_Q}</p></article><div id="comments" drop><article class="comment"><header>A reader</header>
    <p>{_P}</p></article><article class="comment"><p>{_P}</p><p>{_Q}</p></article></div></main></body></html>""",
    f"""<html><body drop><article keep><h1>Title</h1><p>{_P}</p><section class="comments" drop><h2>Comments</h2><p>{_P}</p><p>{_P}</p></section></article></body></html>""",
    f"""<html><body keep><h1>Title</h1><p>{_P}</p><p>{_P}</p><aside drop><p>{_P}</p><p>{_Q}</p></aside><section id="comments" drop><p>{_P}</p></section></body></html>""",
    f"""<html><body drop><header drop><h1>Site name</h1></header><article keep><h1>Title</h1><p>{_Q}</p></article><aside drop>{_P}</aside><div class="comments" drop>
    <h3>Comments</h3><p>{_P}</p></div><form drop><p>Sign up</p></form><footer drop><p>{_Q}</p></footer></body></html>""",
    f"""<html><body drop><header class="site-header" drop><h1>Site name</h1><p>{_P}</p></header><div class="cookie-banner" drop>{_P}</div><main keep><article><h1>Title</h1>
    <p>{_P}</p><h2>Sub</h2><p>{_Q}</p></article></main><aside class="sidebar" drop><h2>Side</h2><p>{_P}</p></aside><footer drop><p>{_P}</p></footer></body></html>""",
    f"""<html><body drop><div class="cookie" drop>We use cookies.</div><main keep><p>{_Q}</p><p>{_Q}</p></main><footer drop>{_Q}</footer></body></html>""",
    f"""<html><body drop><header drop>{_Q}</header><main keep><h1>Title</h1><p>{_Q}</p><ul><li>One.</li><li>Two.</li></ul></main><aside drop>{_Q}</aside></body></html>""",
    f"""<html><body drop><nav drop>{_MENU}</nav><div class="content" keep><h1>Title</h1><p>{_Q}</p><p>{_Q}</p></div><div class="notice" drop>{_P}</div></body></html>""",
    f"""<article keep><p>{_P}</p></article>""",
    f"""<html><body drop><article keep><p>{_P}</p></article></body></html>""",
    f"""<html><body drop><nav drop>{_MENU}</nav><article keep><p>{_Q}</p></article><footer drop><p>{_P}</p></footer></body></html>""",
)
