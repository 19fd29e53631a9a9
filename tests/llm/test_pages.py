"""Templates, URL models, archives: against brute force and round trips, and on awkward rows."""

from __future__ import annotations

import gzip
import html
import io
import math
import re
import time
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tidemark.llm import queries, templates, urls, warc
from tidemark.llm.hashcounts import write_counts

PAGES = "page_id long, url string, html string"


def plain_article(page: str) -> str:
    """The given pages mark their article; its blocks end at p, h1 and br."""
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = [html.unescape(re.sub("<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1|br)>", inner)]
    return " ".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def test_main_texts_of_all_pages(spark, rows):
    found = {r["page_id"]: r for r in queries.op2_page_templates(spark, SF_DIR).collect()}
    for p in rows("pages"):
        r = found[p["page_id"]]
        assert (r["url"], r["text"]) == (p["url"], plain_article(p["html"]))
        assert r["n_chars"] == len(r["text"])
    assert len(found) == len(rows("pages"))


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body><header><a>Menu</a></header><article><header><h1>Title &eacute;</h1><p>by</p></header><p>One<b>two</b> a<br>b<p>c"
         "<aside>no</aside><div class='share-buttons'>no</div><section id=comments><p>no</article><div class=sidebar>no</div>",
         "Title é Onetwo a b c"),
        ("<html><body><nav>n</nav><div id='main-content'><p>x &lt;b&gt; &amp; 1 < 2</p><script>var x='<p>no</p>'</script>"
         "<!-- <p>no</p> --><form><input>f</form></div><div class='cookie-notice'>no</div>", "x <b> & 1 < 2"),
        ("", ""), ("plain text", "plain text"), ("<p>a</p", "a"), ("<article><p>cut &am", "cut &am"), ("<", "<"),
        ("<table><tr><td>x<td>y<tr><td>z</table>", "x y z"), ("<ul><li>a<li>b</ul></p></div>c", "a b c"),
        ("<article class='comment'>no</article><main><p>yes</main><p>no", "yes"),
        ("<p title='a>b'>q&nbsp;\n r</p><style>p{}</style><textarea><p>no</textarea>", "q r"),
    ],
)
def test_main_text_by_tags_alone(page, text):
    assert templates.main_text(page, [], {}) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='layout has-sidebar'><article><p>a</article><div class=sidebar>no</div></div>", "a"),
        ("<div class='no-comments'><p>a</div><div class='page withBanner'><p>b</div><div class=top-banner>no</div>", "a b"),
        ("<div class='sidebar wrapper'><div><main><p>a</main></div></div><div class=related><article>no</article></div>", "a"),
        ("<main><p>long text<div class=related><article>no</article></div></main>", "long text"),
        ("<div><p>long text</div><div class=related><article>no</article></div>", "long text"),
        ("<article><p>a</article><div class='related'><article><p>no</article></div>", "a"),
        ("<article><div class='entry-header'><h1>Title</h1><p>by</p></div><p>a<div class=share><h3>no</h3></div></article>", "Title a"),
        ("<div class='nav-box'><article><div class='entry-header'><h1>Title</h1></div><p>a</article></div>", "Title a"),
        ("<p><a title=it's>one</a> two <b class=x>don't</b></p><p title='a>b' hidden>no</p>", "one two don't"),
    ],
)
def test_names_set_aside_only_the_part_they_name(page, text):
    assert templates.main_text(page, [], {}) == text


def site(k: int, host: str) -> tuple:
    top = "<html><body><div>Our site</div><div><span>Home</span><span>About us</span></div>"
    return (k, f"http://{host}/{k}", f"{top}<div><h2>Title {k}</h2><p>words number {k} and {k * k}</p></div><div>All rights kept</div></body></html>")


@pytest.mark.parametrize("broadcast", [True, False])
def test_template_text_goes_from_unmarked_pages(frame, request, broadcast):
    if not broadcast:
        request.getfixturevalue("forced_skew")
    given = [site(k, "a.com") for k in range(30)] + [site(k, f"b{k}.com") for k in range(30, 33)]
    found = {r["page_id"]: r["text"] for r in templates.main_texts(frame(PAGES, given)).collect()}
    for k in range(30):
        assert found[k] == f"Title {k} words number {k} and {k * k}"
    assert found[31] == "Our site HomeAbout us Title 31 words number 31 and 961 All rights kept"


def test_copies_are_no_template(frame):
    given = [(k, "http://a.com/x", "<article><h1>Same</h1><p>text of all</p></article>") for k in range(20)]
    given += [(50, None, None), (51, "no host", ""), (None, "http://b.com/", "<p>x"), (51, "no host", "")]
    found = templates.main_texts(frame(PAGES, given)).collect()
    assert sorted(r["text"] for r in found) == ["", "", "", *["Same text of all"] * 20, "x"]
    assert templates.main_texts(frame(PAGES, [])).count() == 0


def test_classes_need_equal_vectors_order_and_nesting(frame):
    pages = [(k, f"http://a.com/{k}", f"<div><i>top</i><p>{k}</p>{'<u>new</u><s>note</s>' if k % 2 else ''}<i>end</i></div>") for k in range(20)]
    narrow = frame("host string, page long, html string", [("a.com", k, h) for k, _, h in pages])
    (row,) = templates.host_templates(narrow).collect()
    texts = [[t["is_text"] for t in c].count(True) for c in row["classes"]]
    assert texts == [2, 0, 2]  # the page's own class, the tag that stands twice, the class of every other page
    found = templates.parse(pages[1][2], {})
    every = [[t["token"] for t in c] for c in row["classes"]]
    shown = {r.text for i, r in found.runs if i in templates.template_places(found.tokens, every)}
    assert shown == {"top", "end", "new", "note"}
    apart = templates.parse("<div><u>new</u><i>top</i><p>5</p><s>note</s><i>end</i></div>", {})
    shown = {r.text for i, r in apart.runs if i in templates.template_places(apart.tokens, every)}
    assert shown == {"top", "end"}


def plain_verdict(url: str | None) -> tuple:
    rest = (url or "").split("://", 1)
    if len(rest) < 2:
        return "", "", None, None
    host = re.split("[/?#]", rest[1], maxsplit=1)[0]
    path = re.split("[?#]", rest[1][len(host) :], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def test_rules(frame, rows):
    odd = [
        None, "", "no scheme/en/", "http://EXAMPLE.com/en/1", "http://a.www.example.com/en/", "http://www.example.com/en",
        "http://x.com", "http://x.com?y=/", "ftp://notcom/", "http://com/", "http://b.net/es/", "http://b.net/ES/", "x://y://z.com/",
        "http://ÉA.com/\n/en/?#", "http://example.com:80/en/", "://h.net/fr/x#y?z", "http://xexample.com/en/",
    ]
    given = [(i, u, None) for i, u in enumerate(odd + [p["url"] for p in rows("pages")] + odd)]
    found = {r["id"]: r for r in urls.judge(frame(PAGES, given)).collect()}
    for i, u, _ in given:
        host, path, rule, verdict = plain_verdict(u)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
        assert found[i]["verdict"] == verdict if verdict else found[i]["verdict"] in ("allow", "block")


def test_models_tell_held_out_rule_urls_apart(spark, rows):
    judged = urls.judge(spark.read.parquet(f"{SF_DIR}/pages.parquet"))
    known = [(p["url"], plain_verdict(p["url"])[3]) for p in rows("pages") if plain_verdict(p["url"])[3]]
    model = urls.train(spark.createDataFrame(known[::2], "url string, verdict string"))
    asked = known[1::2]
    import pyarrow as pa

    scores = model.scores(pa.array([u for u, _ in asked]))
    right = [(s >= model.threshold) == (v == "allow") for s, (_, v) in zip(scores, asked)]
    assert sum(right) > 0.7 * len(right)  # learned from some thirty URLs
    assert judged.count() == len(rows("pages"))


def test_models_without_urls(frame):
    assert urls.judge(frame(PAGES, [])).count() == 0
    (row,) = urls.judge(frame(PAGES, [(None, None, None)])).collect()
    assert (row["host"], row["path"], row["rule"], row["verdict"], row["score"]) == ("", "", None, "allow", 0.0)


def test_archives_round_trip_awkward_rows(spark, frame):
    given = [
        (1, "http://a/é\r\nX: y", "<p>same</p>"), (2, None, "<p>same</p>"), (5, "http://b", "<p>same</p>"), (None, "u", "<p>same</p>"),
        (3, "http://c", None), (4, "http://d", ""), (6, "http://e", "ü" * 70_000), (7, "f", "\r\n\r\nWARC/1.1\r\n"), (7, "f", "\r\n\r\nWARC/1.1\r\n"),
        (None, None, None),
    ]
    found = warc.round_trip(spark, frame(PAGES, given)).collect()
    want = []
    for i, _, h in given:
        payload = (h or "").encode()
        newest = max((j for j, _, g in given if (g or "") == (h or "") and j is not None), default=None)
        old = newest is not None and i != newest
        want.append((i, len(payload), warc.digest32(payload), "revisit" if old else "response", newest if old else None))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert warc.round_trip(spark, frame(PAGES, [])).count() == 0


@pytest.mark.parametrize("limit", [warc.LIMIT32, 20])
def test_directories_are_those_of_zip(limit):
    """Python's own reader agrees; with a low limit every size and offset stands in ZIP64 fields."""
    out, parts = io.BytesIO(), {"a/one": [b"first ", b"member"], "two": [b"x" * 50], "empty": []}
    writer = warc.ZipWriter(out, limit)
    for name, data in parts.items():
        writer.add(name, data)
    writer.close()
    with zipfile.ZipFile(out) as z:
        assert {n: z.read(n) for n in z.namelist()} == {n: b"".join(p) for n, p in parts.items()}
    found = warc.members(out, len(out.getvalue()))
    assert {m.name: out.getvalue()[m.offset : m.offset + m.size] for m in found} == {n: b"".join(p) for n, p in parts.items()}
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("m", b"stored")
        z.comment = b"a comment PK\5\6 with a signature"
    (m,) = warc.members(plain, len(plain.getvalue()))
    assert plain.getvalue()[m.offset : m.offset + m.size] == b"stored"


def test_broken_archives_are_refused():
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m", b"text " * 99)
    with pytest.raises(ValueError, match="not stored"):
        warc.members(packed, len(packed.getvalue()))
    with pytest.raises(ValueError, match="no end"):
        warc.members(io.BytesIO(b"PK nothing"), 10)


WARC_FIELDS = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-target-uri", "content-type"}


def _strict(raw):
    """A record as other readers take it: the mandatory fields, their forms, the block's length and digests."""
    import re

    plain = gzip.decompress(raw)
    head, rest = plain.split(b"\r\n\r\n", 1)
    lines = head.decode("ascii").split("\r\n")
    assert lines[0] == "WARC/1.1" and all(re.fullmatch(r"[A-Za-z-]+: [!-~]( |[!-~])*", l) for l in lines[1:])
    fields = {k.lower(): v for k, v in (l.split(": ", 1) for l in lines[1:])}
    assert len(fields) == len(lines) - 1 and WARC_FIELDS <= fields.keys()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["warc-date"])
    assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["warc-record-id"])
    assert re.fullmatch(r"[!-~]+", fields["warc-target-uri"]) and fields["warc-type"] in ("response", "revisit")
    assert ("warc-refers-to" in fields) == ("warc-profile" in fields) == (fields["warc-type"] == "revisit")
    block, end = rest[:-4], rest[-4:]
    assert end == b"\r\n\r\n" and len(block) == int(fields["content-length"])
    assert fields["warc-block-digest"] == "sha1:" + warc.digest32(block)
    http, payload = block.split(b"\r\n\r\n", 1)
    assert http.startswith(b"HTTP/1.1 200 OK\r\n")
    if fields["warc-type"] == "response":
        assert fields["warc-payload-digest"] == "sha1:" + warc.digest32(payload)
    return fields


def test_records_and_index_lines_stand_a_strict_reader(spark, frame, tmp_path):
    import json
    import re
    from urllib.parse import unquote
    import zipfile

    urls = ["http://A.example.com/é中\t x?q=1", "https://b.example.com:8080/Path#top", "no scheme", None, "", "http://b.example.com/a b"]
    given = [(i, u, f"<p>{i % 4} é</p>") for i, u in enumerate(urls * 3)]
    folder = f"{tmp_path}/archives"
    archives = warc.write_archives(warc.classified(frame(PAGES, given)), folder).collect()
    seen, ids, referred = [], {}, []
    for a in archives:
        with zipfile.ZipFile(a["path"]) as z:
            data, lines = z.read(warc.DATA), z.read(warc.INDEX).decode().split("\n")
        assert lines[-1] == "" and lines[:-1] == sorted(lines[:-1])
        for line in lines[:-1]:
            key, stamp, text = line.split(" ", 2)
            entry = json.loads(text)
            fields = _strict(data[int(entry["offset"]) :][: int(entry["length"])])
            assert re.fullmatch(r"\d{14}", stamp) and stamp == re.sub(r"\D", "", fields["warc-date"])
            assert key == warc.sort_key(entry["url"]) and entry["url"] == fields["warc-target-uri"]
            assert {"mime", "status", "digest", "filename"} <= entry.keys() and entry["digest"] == fields["warc-payload-digest"]
            seen.append((int(fields["warc-page-id"]), unquote(entry["url"])))
            ids[fields["warc-record-id"]] = fields["warc-type"]
            referred.append(fields.get("warc-refers-to"))
    assert sorted(seen) == sorted((i, u or f"urn:page:{i}") for i, u, _ in given)
    assert all(ids[r] == "response" for r in referred if r) and len(ids) == 18 and sum(r is not None for r in referred) == 14


def test_sort_keys():
    keys = {"http://www.Example.com:80/A?b=C#d": "com,example,www)/a?b=c", "https://x.org": "org,x)/", "urn:page:3": "urn:page:3"}
    assert {u: warc.sort_key(u) for u in keys} == keys
    assert warc.target_uri(1, "http://h/é中\t") == "http://h/%C3%A9%E4%B8%AD%09"


def test_one_payload_in_half_of_the_pages(spark, frame, forced_skew):
    given = [(i, f"http://h/{i}", "" if i % 2 else f"<p>{i}</p>") for i in range(400)]
    found = {r["page_id"]: r for r in warc.round_trip(spark, frame(PAGES, given)).collect()}
    assert len(found) == 400
    assert all(found[i]["refers_to"] == (399 if i % 2 and i < 399 else None) for i in range(400))


def test_headers_are_read_however_they_are_spelled():
    body = b"HTTP/1.1 200 OK\r\ncontent-LENGTH:2\r\n\r\nok"
    head = f"WARC/1.0\r\nwarc-type:response\r\nCONTENT-length:   {len(body)}\r\n\r\n".encode()
    found = warc.parse_record(gzip.compress(head + body + b"\r\n\r\n"))
    assert (found["warc-type"], found["http"]["content-length"], found["payload"]) == ("response", "2", b"ok")


def _markov(train, url):
    """Log-likelihood difference by dicts of counts, per byte."""
    total = 0.0
    p = {}
    for at in range(len(url)):
        for side in ("allow", "block"):
            p[side] = 1 / 256
            for order in range(urls.ORDER + 1):
                starts = min(order, at)
                key = (order, starts, url[at - starts : at])
                own, seen = train[side].get((key, url[at]), 0), train[side].get(key, 0)
                p[side] = (own + urls.BACK_OFF * p[side]) / (seen + urls.BACK_OFF)
        total += math.log(p["allow"]) - math.log(p["block"])
    return total / max(len(url), 1)


@pytest.mark.parametrize("per_file", [1 << 21, 500])
def test_scores_are_those_of_the_markov_models(spark, frame, rows, monkeypatch, per_file):
    monkeypatch.setattr("tidemark.llm.hashcounts.FILE", per_file)
    given = [(p["page_id"], p["url"]) for p in rows("pages")[:200]] + [(900, None), (901, ""), (902, "http://é.org/" + "a" * 5000)]
    found = {r["id"]: r for r in urls.judge(frame("page_id long, url string", given)).collect()}
    train = {"allow": Counter(), "block": Counter()}
    for i, u in given:
        raw = (u or "").encode()
        if u is None or found[i]["rule"] is None or zlib.crc32(raw) % urls.CALIBRATE == 0:
            continue
        for at in range(len(raw)):
            for order in range(urls.ORDER + 1):
                starts = min(order, at)
                key = (order, starts, raw[at - starts : at])
                train[found[i]["verdict"]].update([key, (key, raw[at])])
    assert all(train.values())
    asked = [(i, u) for i, u in given if found[i]["rule"] is None]
    assert len(asked) > 20
    for i, u in asked:
        assert found[i]["score"] == pytest.approx(_markov(train, (u or "").encode()), abs=1e-9)


def test_hash_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.llm.hashcounts.FILE", 100)
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    n = rng.integers(1, 1 << 40, len(hashes))
    df = spark.createDataFrame(list(zip(hashes.view(np.int64).tolist(), n.tolist())), "hash long, n long")
    counts = write_counts(df, f"{tmp_path}/counts")
    assert (counts[hashes[::-1]] == n[::-1]).all() and len(counts.parts) == 16
    assert counts[np.array([5, 1 << 63], dtype=np.uint64)].tolist() == [0, 0]
    assert write_counts(df.limit(0), f"{tmp_path}/none")[hashes[:3]].tolist() == [0, 0, 0]


@pytest.mark.parametrize(
    "page",
    [
        '<div class="ad">{n}x',
        "<div><b>{n}</i>{n}</p>{n}",
        '<div class="ad">{n}<main>{n}y',
        "<main>{n}<article class='related'>{n}z",
        "<ul><li>{n}",
    ],
)
def test_deep_nesting_costs_no_more_than_its_tags(page):
    def seconds(n):
        parts = page.split("{n}")
        start = time.process_time()
        templates.parse("".join(p * n for p in parts[:-1]) + parts[-1], {})
        return time.process_time() - start

    seconds(100)
    few, many = seconds(1000), seconds(16_000)
    assert many < 64 * max(few, 0.005)


def test_text_of_a_deeply_nested_page():
    deep = '<div class="ad">' * 3000
    assert templates.main_text(f"{deep}advert{'</div>' * 3000}<p>text", [], {}) == "text"
    assert templates.main_text(f"{deep}<main><p>kept</p></main>{'</div>' * 3000}", [], {}) == "kept"
    assert templates.main_text(f"<ul>{'<li>' * 3000}<p>a<p>b", [], {}) == "a b"
