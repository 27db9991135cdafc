"""Operators on texts against brute force and hand-made cases."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import language, leaks, licences, mixing, near_copies, pages, passages, quality, tokens, words
from ledgerlens.llm.queries import tokenizer_path
from ledgerlens.sources import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keys string, node string, row string"


def documents(spark, rows):
    """(doc_id, text, lang, source) rows with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, "k", "n", "r") for r in rows], SCHEMA)


def prose(seed, n, lang="en"):
    random = np.random.default_rng(seed)
    stems = {"en": ["the", "of", "ing", "th", "er"], "de": ["der", "und", "sch", "ung", "ß"]}[lang]
    return " ".join("".join(random.choice(stems, random.integers(1, 4))) + str(seed % 7 or "") for _ in range(n)) + "."


def word_list(text):
    return [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]


def shingle_set(text):
    w = word_list(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_words_match_plain_splitting():
    texts = ["", "a", "  A b\tc\x0bd\n", "é" * 3, "x y z w v u", None, "a", "a"]
    column = pa.array([None if t is None else t.encode() for t in texts], pa.binary())
    names = defaultdict(set)
    for found in words.words(column, chunk=8):
        for i in range(len(found)):
            own = found.hashes[found.bounds[i] : found.bounds[i + 1]]
            plain = word_list(texts[found.first + i])
            assert len(own) == len(plain)
            for w, h in zip(plain, own.tolist()):
                names[w].add(h)
    assert all(len(v) == 1 for v in names.values()) and len({h for v in names.values() for h in v}) == len(names)
    assert [len(s) for s in words.shingle_sets(column)] == [len(shingle_set(t)) for t in texts]


def test_pieces_encode_as_whole_texts():
    encode = tokens.Encoder(tokenizer_path(), 0)
    random, alphabet = np.random.default_rng(3), list("ab Zé'\n\t.,!s12²Ⅷß|*\x1c\x85文_-’ ") + ["'ll", "  ", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(random.choice(alphabet, random.integers(0, 25)))
        want = encode._tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert np.frombuffer(encode([text])[0], "<u2").tolist() == want, repr(text)


def test_pieces_encode_alike_however_texts_are_split(monkeypatch):
    """Words between single spaces, long texts piece by piece, pieces let go and met again."""
    rng = np.random.default_rng(3)
    parts = ["a", "Zé", "ß'", "'s", "T1", " ", "  ", " \n", "\t", "\u3000", "日本", ".", ",!", "_-", "x\u0301", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts, n)) for n in rng.integers(0, 30, 400)]
    texts += ["one two  three", "a b\n c \nd ", " a", "a ", "\n a", ""]
    want = None
    for kept_, at_once in [(300_000, 1 << 20), (5, 1 << 20), (300_000, 3)]:
        monkeypatch.setattr(tokens, "_KEPT", kept_)
        monkeypatch.setattr(tokens, "_AT_ONCE", at_once)
        encode = tokens.Encoder(tokenizer_path(), 0)
        assert encode._model is not None
        if want is None:
            whole = (encode._tokenizer.encode(t, add_special_tokens=False).ids for t in texts)
            want = [np.array([*ids, 0], "<u2").tobytes() for ids in whole]
        assert encode(texts) == want
        assert tokens.Encoder(tokenizer_path(), 0, by_piece=False)(texts) == want


def test_token_records(spark):
    rows = [(5, "five of them", "en", "a"), (1, None, None, None), (3, "", "en", "a"), (None, "none", "en", "a")]
    rows += [(5, "five of them", "en", "a"), (9, "long words " * 5000, "en", "b")]
    files = tokens.write_token_shards(documents(spark, rows), tokenizer_path(), Scratch(spark, "t"), shard_bytes=64)
    got = tokens.read_token_shards(spark, files).orderBy("start").collect()
    encode = tokens.Encoder(tokenizer_path(), 0)
    start = 0
    for row, (doc_id, text) in zip(got, sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))):
        ids = np.array(encode._tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(rows) and files.shards.count() > 2
    some = tokens.read_records(spark, files, files.index.filter("doc_id = 9")).first()
    assert len(some.ids) == len(encode(["long words " * 5000])[0]) // 2
    with pytest.raises(ValueError):
        list(tokens.parsed(tokens.record(1, b"ab", 2)[:-1] + b"\0"))
    none = documents(spark, [])
    assert tokens.read_token_shards(spark, tokens.write_token_shards(none, tokenizer_path(), Scratch(spark, "t"))).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; <b>line</b></h1><p>One<br>two &nbsp; three
<p>Four &lt;five&gt;<script>var x="</p>"</script></p><div class="ad">Buy</div><form>Name</form><p>Six</article>
<section id="comments"><p>First!</p></section><aside>More</aside><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    assert pages.main_text(PAGE) == "Head & line\n\nOne two three\n\nFour <five>\n\nSix"
    plain = "<div id=menu><a href=x>A</a></div><p>" + "word " * 30 + "</p><p>short end</p><div class=footer>bye</div>"
    assert pages.main_text(plain) == ("word " * 30).strip() + "\n\nshort end"
    for odd in (None, "", "<", "<p", "<!-- open", "<script>never", '<a href="x', "</p></div>", "<nav>only</nav>"):
        assert pages.main_text(odd) in ("", "<")
    table = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x")], "page_id long, url string, html string, text string")
    got = pages.extract(table).collect()
    assert sorted(r.n_chars for r in got) == [0, len(pages.main_text(PAGE)), len(pages.main_text(PAGE))]
    assert pages.extract(table.limit(0)).count() == 0


def test_main_text_is_whole():
    long = ("word " * 30).strip()
    furniture = "<form>Name</form><div class=ad>Buy</div><div class='ad-slot'>Now</div><div id=share>Share</div>"
    assert pages.main_text(f"<p>{long}</p>{furniture}<p>The end.</p>") == long + "\n\nThe end."
    assert pages.main_text(f"<p>See <a href=x>{long}</a></p><p>{long}</p>") == f"See {long}\n\n{long}"
    for wrapper in ("layout with-sidebar", "sidebar", "share", "comments"):
        page = f"<nav>Menu</nav><div class='{wrapper}'><article><p>{long}</p>{furniture}<p>End</p></article></div><footer>me</footer>"
        assert pages.main_text(page) == long + "\n\nEnd", wrapper
    assert pages.main_text(f"<div class='layout with-sidebar'><p>{long}</p></div><div class=sidebar>x</div>") == long
    talk = "<section id=comments><article><p>First!</p></article></section><article class=comment>Second</article>"
    assert pages.main_text(f"<article><p>{long}</p></article>{talk}") == long


def test_main_text_where_marks_mislead():
    long = ("word " * 30).strip()
    assert pages.main_text(f"<p>{long}</p><svg/><svg width='3' /><p>End</p>") == long + "\n\nEnd"
    for attribute in ('data-role="navigation"', 'data-id="comments"', 'title="id=menu"', 'title="see class=footer"', "class=text class=menu"):
        assert pages.main_text(f"<div><p {attribute}>{long}</p></div>") == long, attribute
    assert pages.main_text(f"<nav><a href=x>Menu</a><article><p>{long}</p></article>") == long
    assert pages.main_text(f"<div><nav><a href=x>Menu</a></div><article><p>{long}</p></article>") == long
    assert pages.main_text(f"<nav><article>Menu</article></nav><p>{long}</p>") == long
    assert pages.main_text(f"<form action=x><input><main><p>{long}</p></main></form>") == long
    assert pages.main_text("<form action=x><p>Your name</p></form>") == ""
    for name in ("notice-main", "main-widget"):
        assert pages.main_text(f"<div class='{name}'><p>{long}</p></div><div class=footer>me</div>") == long, name
        assert pages.main_text(f"<div class='{name}'><p>x</p></div><p>{long}</p>") == long, name
    for name in ("main-menu", "nav-main", "notice", "main notice"):
        assert pages.main_text(f"<div class='{name}'><p>{long}</p></div>") == "", name


def test_windows_tell_a_teaser_from_the_article():
    body = [("word " * (20 + k)).strip() for k in range(4)]
    page = "<article><p>Read this as well</p></article>" + "".join(f"<p>{x}</p>" for x in body)
    assert pages.main_text(page) == "\n\n".join(["Read this as well", *body])
    # Much text beside an article, but in no window as much as in the article.
    lines = "".join(f"<div>{k} link of some length</div>" for k in range(60))
    page = f"<article><p>{body[3]}</p><p>{body[2]}</p></article>{lines}"
    assert pages.main_text(page) == body[3] + "\n\n" + body[2]
    assert pages.main_text(page, window=60) != pages.main_text(page)
    assert pages.main_text(f"<main><p>Short</p></main>{lines}<p>{body[3]}</p>") == "Short"


def test_near_copies(spark):
    base = [prose(i, 120) for i in range(6)]
    rows = [(10 * i, t, "en", "s") for i, t in enumerate(base)]
    for i, t in enumerate(base):
        w = t.split()
        rows += [(10 * i + 1, t.upper(), "en", "s"), (10 * i + 2, " ".join([*w[:-1], "end"]), "en", "s")]
        rows += [(10 * i + 3, " ".join([*w[:60], "x", *w[61:]]), "en", "s"), (10 * i + 4, " ".join(w[:70]), "en", "s")]
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "a b", "en", "s"), (903, "A  b", "en", "s"), (0, base[0], "en", "s")]
    rows.append((None, base[0], "en", "s"))
    got = near_copies.near_copies(documents(spark, rows), Scratch(spark, "n")).collect()
    assert len(got) == len(rows)
    sets = {i: shingle_set(t) for i, t, *_ in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    assert near_copies.near_copies(documents(spark, []), Scratch(spark, "n")).count() == 0


def test_one_document_of_each_group(spark):
    a, b = prose(1, 80), prose(2, 80)
    near = " ".join([*a.split()[:-1], "end"])
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (1, a, "en", "t"), (2, near, "en", "s"), (3, b, "en", "s"), (4, prose(3, 80), "en", "s")]
    rows += [(5, None, "en", "s"), (5, "", "en", "s"), (5, "", "en", "s"), (6, "", "en", "s"), (None, a, "en", "s"), (None, a, "en", "s")]
    docs = documents(spark, rows).withColumn("mark", F.lit("m"))
    stays = near_copies.one_of_each(docs, Scratch(spark, "n"))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in stays.collect())
    assert got == sorted([(1, a), (1, b), (4, prose(3, 80)), (5, ""), (5, ""), (5, ""), (6, ""), (-1, a), (-1, a)])
    assert stays.columns == docs.columns and near_copies.one_of_each(docs.limit(0), Scratch(spark, "n")).count() == 0


def test_leaks_match_brute_force(spark):
    items = [(i, prose(50 + i, 20 + 3 * i)) for i in range(8)] + [(8, "one two three"), (9, None), (10, "")]
    rows = []
    for i, text in items[:8]:
        w = text.split()
        rows += [(i, f"{prose(i, 30)} {text} {prose(i + 90, 30)}", "en", "s"), (20 + i, " ".join(w[2:]), "en", "s")]
        rows += [(40 + i, f"a b {' '.join([*w[:-1], 'x'])} c", "en", "s"), (60 + i, " ".join(w[: len(w) // 2]), "en", "s")]
    rows += [(80, "zero one TWO three four", "en", "s"), (81, None, "en", "s"), (82, "", "en", "s"), (None, items[0][1], "en", "s")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.shared, r.total) for r in leaks.leaks(documents(spark, rows), benchmark).collect()}
    want = {}
    for doc_id, text, *_ in rows:
        for item, passage in items:
            n = min(5, len(word_list(passage)))
            if not n:
                continue
            cut = lambda t: [tuple(w[i : i + n]) for w in [word_list(t)] for i in range(len(w) - n + 1)]
            own, there = cut(text), Counter(cut(passage))
            for start in range(1 - there.total(), len(own)):
                here = Counter(own[max(0, start) : max(0, start + there.total())])
                shared, total = (here & there).total(), (here | there).total()
                if 5 * shared >= 4 * total and shared * want.get((doc_id, item), (0, 1))[1] > want.get((doc_id, item), (0, 1))[0] * total:
                    want[doc_id, item] = (shared, total)
    assert got == want and len(want) > 20
    clean = leaks.without_leaks(documents(spark, rows), benchmark)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {k[0] for k in want}
    assert leaks.leaks(documents(spark, rows), benchmark.limit(0)).count() == 0


def test_leaks_do_not_depend_on_chunks(monkeypatch):
    """A long text made of all items, searched a few windows at a time, holds each item once and whole."""
    passages = [prose(200 + i, 30 + i % 3) for i in range(60)] + [prose(200, 30)]
    items = leaks.Items.of(list(range(61)), [p.encode() for p in passages], leaks.RADIUS)
    text = " ".join(passages)
    texts = [text, None, "", " ".join(text.split()[7:]), prose(1, 3000), passages[3]]
    search = lambda: [
        row for run in words.words(pa.array([t and t.encode() for t in texts], pa.binary())) for row in items.in_texts(run, 80)
    ]
    whole = search()
    assert {d["item_id"] for d in whole[0]} == set(range(61)) and all(d["shared"] == d["total"] for d in whole[0])
    assert whole[0][0]["first_word"] == whole[0][60]["first_word"] == 0
    assert whole[1] == whole[2] == whole[4] == [] and [d["item_id"] for d in whole[5]] == [3]
    for places, signed in [(1, 1), (100, 50), (3000, 400)]:
        monkeypatch.setattr(leaks, "_PLACES", places)
        monkeypatch.setattr(leaks, "_SIGNED", signed)
        assert search() == whole


def test_quality(spark):
    rows, labels = [], []
    for i in range(80):
        poor = i % 4 == 0
        text = " ".join(["spam!!"] * 60) if poor else prose(i, 80)
        rows.append((i, text, "en" if i % 3 else None, f"s{i % 5}" if i % 7 else None))
        if i % 2 == 0:
            labels.append((i, 0 if poor else 1, 0))
    rows += [(500, None, "en", "s1"), (501, "", "en", "rare"), (None, prose(3, 80), "en", "s1")]
    table = spark.createDataFrame(labels + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows).withColumn("quality", F.lit("x"))
    scored, names = quality.quality(docs, table, Scratch(spark, "q"))
    got = scored.collect()
    assert len(got) == len(rows) and names[-1] == "quality_" and set(docs.columns) <= set(scored.columns)
    for r in got:
        assert 0 <= r[names[-1]] <= 1
        if r.doc_id is not None and r.doc_id < 500:
            assert (r[names[-1]] >= 0.5) == (r.doc_id % 4 != 0)
    plain, names = quality.quality(docs, table.limit(0), Scratch(spark, "q"))
    assert {r[names[-1]] for r in plain.select(names[-1]).collect()} == {0.5}
    assert quality.quality(docs.limit(0), table, Scratch(spark, "q"))[0].count() == 0


def test_mixing(spark):
    rows = [(i, prose(i, 20), "en", "big") for i in range(300)] + [(1000 + i, prose(i, 20), "en", None) for i in range(30)]
    rows += [(2000, None, "en", "tiny"), (2001, "", "en", "tiny"), (2001, "", "en", "tiny")]
    docs = documents(spark, rows)
    mixed, names = mixing.mix(docs, Scratch(spark, "m"), max_repeats=1.5, evenness=1.0, block_tokens=100)
    got = mixed.toPandas()
    times = got.groupby("doc_id").size()
    assert set(times.index) == {r[0] for r in rows} and times[times.index < 1000].eq(1).all()
    size = got.groupby("source", dropna=False)["tokens"].sum()
    assert size["tiny"] <= 3 * 1.5 + 100 and 630 * 1.1 < size[np.nan] < 630 * 1.5 + 150
    assert got["place"].between(0, 1).all() and names == ["tokens", "weight", "pass", "block", "place"]
    even, _ = mixing.mix(docs.filter("source = 'big'"), Scratch(spark, "m"))
    assert even.count() == 300
    assert mixing.mix(docs.limit(0), Scratch(spark, "m"))[0].count() == 0
    shares = spark.createDataFrame([(1.0,), (0.1,), (0.1,)], "share double")
    alpha = mixing.exponent(shares, 100.0, 0.95)
    w = np.array([1, 0.1, 0.1]) ** alpha
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() / np.log(3) - 0.95) < 1e-6
    assert abs(mixing.exponent(shares, 2.0, None) - (1 - np.log(2) / np.log(10))) < 1e-9


def test_language(spark):
    rows = [(i, prose(i, 40, "de" if i % 2 else "en"), "de" if i % 2 else "en", "s") for i in range(200)]
    rows += [(300, None, "en", "s"), (301, "12 !?", "en", "s"), (302, "", None, "s"), (None, "der und", None, "s")]
    docs = documents(spark, rows)
    model = language.train(docs, F.col("doc_id").isNotNull() & ~language.held_out())
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    for i, r in got.items():
        if i is not None:
            assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
            assert r.lang_pred == ("und" if i >= 300 else "de" if i % 2 else "en")
    assert got[None].lang_pred == "de" and not got[None].held_out
    assert model.predict("schsch")[0] == "de"
    assert [model.predict(t)[0] for t in ("the²", "mⅧ the", "²", "Ⅷ ³")] == ["en", "en", "und", "und"]
    nothing = language.train(docs.limit(0), F.lit(True))
    assert nothing.predict("the")[0] == "und"


def test_language_learns_from_different_texts(spark):
    own = ["".join("abcdefghij"[int(d)] for d in str(1000 + i)) for i in range(300)]
    texts = [f"{w} {w}" for w in own] + ["hot hot"] * 5000
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)] + [(9000, "der der", "de", "s")])
    for sample in (100, 301, 1000):
        model = language.train(docs, F.lit(True), sample=sample)
        assert len(model.words) == min(sample, 301) + 1 and "der" in model.words, sample


def test_passages(spark):
    shared = ". ".join(prose(i, 8).strip(".") for i in range(70, 78)) + "."
    rows = [(1, f"{prose(1, 12)}\nin the middle {shared} goes on\nshort line", "en", "s")]
    rows += [(2, f"other words {shared.upper()} and more\nshort line", "en", "s"), (3, prose(9, 40), "en", "s")]
    rows += [(4, f"{prose(11, 30)}\n{prose(12, 30)}\n{prose(11, 30)}", "en", "s"), (5, None, "en", "s"), (6, "", "en", "s")]
    rows += [(3, prose(9, 40), "en", "s"), (None, f"{prose(9, 40)}", "en", "s")]
    got = passages.without_repeats(documents(spark, rows), Scratch(spark, "p")).collect()
    by = {r.doc_id: r for r in got}
    texts = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows) and by[1].text == texts[1] and by[3].text == texts[3]
    assert by[2].n_removed > 150 and "short line" in by[2].text and by[2].text.startswith("other words")
    assert by[4].text.count(prose(11, 30)) == 1 and by[5].text is None and by[6].text == "" and by[None].text == ""
    for r in got:
        kept, at, text = "", 0, texts[r.doc_id] or ""
        for span in r.removed:
            kept, at = kept + text[at : span.start], span.end
        assert kept + text[at:] == (r.text or "")
    assert passages.without_repeats(documents(spark, []), Scratch(spark, "p")).count() == 0


def test_licences(spark):
    rows = [(i, "\n".join(prose(i + k, 25) for k in range(3)), "en", "s") for i in range(60)]
    rows += [(100, f"{prose(1, 30)}\nReleased under the MIT License.", "en", "s"), (101, "All rights reserved.", "en", "s")]
    rows += [(102, "Licensed under CC BY-NC 4.0.\nx", "en", "s"), (103, None, "en", "s"), (104, "", "en", "s")]
    rows += [(105, "This driving licence was released under heavy rain by the minister", "en", "s")]
    got = licences.licences(documents(spark, rows), Scratch(spark, "l")).filter("confirmed").collect()
    assert {(r.doc_id, r.paragraph, r.licence) for r in got} == {(100, 1, "MIT"), (101, 0, "Proprietary"), (102, 0, "CC-BY-NC")}


def test_wrapped_licences(spark):
    rows = [(i, "\n".join(prose(i + k, 25) for k in range(3)), "en", "s") for i in range(60)]
    apache = licences.TEMPLATES["Apache-2.0"][1].split()
    wrapped = "\n".join("# " + " ".join(apache[i : i + 5]) for i in range(0, len(apache), 5))
    mit = licences.TEMPLATES["MIT"][1].split()
    mit[9] = "someone"
    rows += [(100, wrapped, "en", "s"), (101, f"{prose(1, 30)}\n\n{prose(2, 30)}\n{wrapped}\n{prose(3, 30)}", "en", "s")]
    rows += [(102, f"All rights reserved.\n{' '.join(mit[:10])}\n{' '.join(mit[10:])}\nSPDX-License-Identifier: MIT", "en", "s")]
    rows += [(103, "Released under\n\nthe MIT License.", "en", "s")]
    found = licences.licences(documents(spark, rows), Scratch(spark, "l")).collect()
    got = {(r.doc_id, r.paragraph, r.licence): r.cover for r in found if r.confirmed and r.doc_id != 103}
    assert set(got) == {(100, 0, "Apache-2.0"), (101, 3, "Apache-2.0"), (102, 0, "Proprietary"), (102, 1, "MIT"), (102, 3, "MIT")}
    assert got[100, 0, "Apache-2.0"] == got[101, 3, "Apache-2.0"] == 1 and 0.7 < got[102, 1, "MIT"] < 1
    assert all(r.cover < 1 for r in found if r.doc_id == 103)


def test_licences_learn_from_different_paragraphs(spark, monkeypatch):
    kept = []
    fit = licences.Pipeline.fit
    monkeypatch.setattr(licences.Pipeline, "fit", lambda self, rows: kept.append(rows) or fit(self, rows))
    lines = [prose(i, 25) for i in range(60)]
    often = "\n".join([f"{x} all rights reserved" for x in lines[:20]] * 30 + lines[:1] * 500)
    rows = [(i, x, "en", "s") for i, x in enumerate(lines)] + [(100, often, "en", "s")]
    licences.licences(documents(spark, rows), Scratch(spark, "l"), sample=60)
    training = [r.text for r in kept[0].filter("label = 0").collect()]
    # A fifth or so is held out of the fit.
    assert set(training) <= set(lines) and len(training) == len(set(training)) > 35


def test_licences_that_resemble_others(spark):
    rows = [(i, "\n".join(prose(i + k, 25) for k in range(3)), "en", "s") for i in range(60)]
    notices = {
        "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
        "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
        "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3 or later.",
        "CC-BY-ND": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    }
    rows += [(100 + k, text, "en", "s") for k, text in enumerate(notices.values())]
    rows += [(200, "Licensed under the Apache License, Version 1.1.", "en", "s")]
    rows += [(201, "The all rights reserved seats were sold long ago", "en", "s")]
    free = licences.TEMPLATES["GPL-3.0"][1]
    rows += [(202, f"{free} as published by the Free Software Foundation; either version 2 of the License, or later", "en", "s")]
    rows += [(203, f"{free} as published by the Free Software Foundation; either version 3 of the License, or later", "en", "s")]
    rows += [(None, "Copyright 2020 Someone. All rights reserved", "en", "s"), (204, "All rights reserved.", "en", "s"), (204, "All rights reserved.", "en", "s")]
    got = licences.licences(documents(spark, rows), Scratch(spark, "l")).filter("confirmed").collect()
    want = [(100 + k, name) for k, name in enumerate(notices)] + [(203, "GPL-3.0"), (None, "Proprietary"), (204, "Proprietary"), (204, "Proprietary")]
    assert sorted(((r.doc_id, r.licence) for r in got), key=str) == sorted(want, key=str)


def test_licence_scores_do_not_depend_on_blocks(monkeypatch):
    random = np.random.default_rng(3)
    weights, biases = random.normal(size=(licences._FEATURES, 4)), random.normal(size=4)
    pieces = [prose(k, n) for k, n in enumerate((5, 0, 900, 1, 2, 3, 40, 300, 7))]
    want = []
    for piece in pieces:
        words = [licences._codes([w], {})[0] for w in licences._WORD.findall(piece.lower())]
        keys = licences._keys(np.array(words, np.uint64), np.zeros(len(words), np.int64))
        want.append(weights[keys].sum(axis=0) + biases)
    for block in (1 << 15, 64, 8):
        monkeypatch.setattr(licences, "_BLOCK", block)
        for split in (lambda p: None, lambda p: licences._WORD.findall(p.lower())):
            got = np.zeros((len(pieces), 4))
            for begin, odds in licences._odds([(k, p, split(p)) for k, p in enumerate(pieces)], {}, weights, biases):
                got[begin : begin + len(odds)] = odds
            assert np.allclose(got, want)


def test_licences_of_an_empty_table(spark):
    assert licences.licences(documents(spark, [(1, None, "en", "s")]).limit(0), Scratch(spark, "l")).count() == 0


def test_main_text_keeps_every_line_with_weight():
    """Lines of the article stay however far apart they lie; no stage beside the weights picks among them."""
    furniture = "<nav><ul>" + "<li>Menu</li>" * 9 + "</ul></nav>"
    assert pages.main_text(f"<p>One</p>{furniture}<p>2</p>{furniture}{furniture}<p>Three</p>") == "One\n\n2\n\nThree"
    assert not hasattr(pages, "spans")
