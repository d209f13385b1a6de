"""The training-data operators against brute force, round trips, and odd inputs."""

import hashlib
import html
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewake.llm import op1_binary, op2_html, op3_quality, op4_pii, op5_chat, op6_counts, op7_shards, op8_packing, op9_minhash, op10_decontaminate, tokens
from tidewake.llm.tokens import load

LONG = "word " * 30_000 + "end\n" * 3 + "x" * 50_000
TEXTS = [None, "", " ", "one", "Hello  world\n\nfoo\tbar 's it's <|endoftext|> x", "same text here now ok", "same text here now ok", "日本語 ÀÉ naïve\x1c\x85 z  ", LONG, "a.b@c.de +1 (743) 555-3824 and 4994226020900891 at 10.0.0.1"]
SCHEMA = "doc_id long, text string, lang string, part int, position long, n_words int, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    rows = [(None if i == 3 else i, t, None, 7, 1, 2, len(t or "")) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (5, "another text with the id five", "x", 1, 1, 1, 1)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_binary(odd, none):
    got = op1_binary.token_digest(odd).orderBy("start").collect()
    tok = load("byte_bpe_50k.json")
    ids = lambda t: np.asarray([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    want = Counter((r.doc_id, len(ids(r.text)), zlib.crc32(ids(r.text).tobytes())) for r in odd.collect())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    assert op1_binary.token_digest(none).count() == 0


def test_codes_round_trip():
    r = np.random.default_rng(3)
    docs = [r.integers(0, 1 << int(r.integers(1, 32)), int(n), dtype=np.uint32) for n in r.integers(0, 50, 40)]
    counts = np.array([len(d) for d in docs])
    control, data, control_ends, data_ends = op1_binary.encode_ids(np.concatenate(docs), counts)
    assert (op1_binary.decode_block(control.tobytes(), data.tobytes(), counts) == np.concatenate(docs)).all()
    for k, d in enumerate(docs):  # and each document from its own bytes
        c, x = (flat[(ends[k - 1] if k else 0) : ends[k]].tobytes() for flat, ends in ((control, control_ends), (data, data_ends)))
        assert (op1_binary.decode_block(c, x, counts[k : k + 1]) == d).all()


PARTS = ["ab", " ", "é", "\n", ".", ",", "\t", "'s", "À", "İ", "\xa0", "e\u0301", "Ω", "漢", "12", "<|endoftext|>", "<|startoftext|>", "  ", "\n\n", "!?", "ǅ", "ŉ", "\u3000", "ﬁ", "the", "Word", "ſ", "\x1c", "\x85", "ª"]


@pytest.mark.parametrize(("name", "cut"), [("byte_bpe_50k.json", tokens.BYTE_LEVEL), ("word_bpe_49k.json", tokens.WORDS)])
def test_pieces_encode_as_the_library_does(name, cut, monkeypatch):
    tok, r = load(name), random.Random(4)
    texts = [None, "", *("".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(4000))]
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]

    def check(own):
        ids, counts = own.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == want

    check(tokens.Encoder(name, cut))
    check(tokens.Encoder(name, cut, cache=50))  # most is forgotten all the time
    monkeypatch.setattr(tokens, "STRETCH", 3)  # every text is a long one
    check(tokens.Encoder(name, cut))
    if cut.byte_level:
        assert op6_counts.Counter(name, cache=50).counts(pa.array(texts, pa.string())).tolist() == [len(x) for x in want]


def test_blocks_over_many_parts(spark):
    """Rows of one id, of none and equal rows lie in several parts and blocks, in order."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"some words {i % 5} " * (i % 40)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    own = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        path = op1_binary.scratch_path(spark, "test")
        op1_binary.write_tokens(docs, path)
        got = op1_binary.read_tokens(spark, path, digest=False).orderBy("start").collect()
        assert spark.read.parquet(f"{path}/blocks").filter("exists(doc_ids, d -> d IS NULL)").select("part").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)
    tok = load("byte_bpe_50k.json")
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((d, (*tok.encode(t, add_special_tokens=False).ids, 2)) for d, t in rows)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda d: (d is not None, d))


PAGE = '<html><head><title>T</title><script>x("</p>")</script></head><body><nav><a href=x>menu</a></nav><div class="ad">buy</div><article class="post-{i}"><h1>Head &amp; {i}</h1><p>First   text &lt;here&gt;<br>more<p>Second<div class=comments>no</div></article><footer>foot'


def test_html(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.replace("{i}", str(i))) for i in range(5)] + [(9, None, None), (9, "odd", ""), (10, "http://x", "<p>a < b &nbsp; c"), (11, "http://y", "<div " + "a='" * 3000)]
    got = {r.page_id: (r.text, r.n_chars) for r in op2_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        want = f"Head & {i}\nFirst text <here> more\nSecond"
        assert got[i] == (want, len(want))
    assert got[9] == ("", 0) and got[10][0] == "a < b c" and got[11] == ("", 0)
    assert html.unescape("&amp;") == "&"


SAID = "<h1>The headline</h1>" + "".join(f"<p>Paragraph {i} of the article says a few words more than a line of a menu would, at least eighty.</p>" for i in range(4))
SAID_TEXT = "The headline\n" + "\n".join(f"Paragraph {i} of the article says a few words more than a line of a menu would, at least eighty." for i in range(4))


def main_of(page):
    return op2_html.extract(op2_html.parse(page), None)


def test_words_of_a_wrapper_do_not_drop_the_article():
    for open_ in ('<div class="site has-sidebar">', '<div class="content with-sidebar">', '<div class="entry-content no-comments">', '<div id="page" class="layout-menu">', '<div class="sidebar-right">', '<div class="sidebar main">', '<section id="menu-page">'):
        for inner in (SAID, f"<article>{SAID}</article>", f'<div class="sidebar">about us</div><article>{SAID}</article><div class="comments"><article class="comment">no</article></div>'):
            assert main_of(f"<html><body>{open_}{inner}</div></body></html>") == SAID_TEXT, (open_, inner)
    long = "<p>" + "words of readers " * 200 + "</p>"
    for drop in ('<div class="comments">', '<div class="post-comments">', '<div class="cookie notice">', '<div class="comments"><article class="comment">', '<div class="related"><article>'):
        assert main_of(f"<html><body><div class=post>{SAID}{drop}{long}</article></div></div></body></html>") == SAID_TEXT, drop
    assert main_of(f'<html><body><article>{SAID}<div class="ad">buy</div></article><div class="sidebar"><article>teaser</article></div></body></html>') == SAID_TEXT


def test_nesting_classes_and_hosts(spark, monkeypatch):
    deep = op2_html.parse("<div class=c1>" * 30_000 + "<p>hello</p>")
    assert len(set(map(id, deep.step))) == 2 and op2_html.extract(deep, None) == "hello"
    # Containers whose classes differ only after the third have their own paths.
    page = "<html><body><div class='a b c x'><p><a href=x>menu words</a></p></div><div class='a b c y'><p>" + "the article says " * 20 + "</p></div></body></html>"
    own = op2_html.parse(page)
    path = own.path(op2_html.best(own))
    assert path.endswith("div.a.b.c.y") and op2_html.extract(own, path) == ("the article says " * 20).strip()
    assert "x + y" in main_of("<article><p>where <math><mi>x + y</mi></math> is</p><canvas>chart</canvas></article>")
    rows = [(i, u, page) for i, u in enumerate(["http://A.example/1", "//a.EXAMPLE:80/2", " https://u@b.example?q", "odd", None, "mailto:x"])]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, host int, path string")  # clashing names
    one = sorted(map(tuple, op2_html.main_text(pages).collect()))
    monkeypatch.setattr(op2_html, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, op2_html.main_text(pages).collect())) == one and len(one) == 6
    hosts = [r.host for r in pages.select("page_id", op2_html.host_of("url")).orderBy("page_id").collect()]
    assert hosts == ["a.example", "a.example", "b.example", "", "", ""]
    assert op2_html.main_text(pages.limit(0)).count() == 0


def test_generated_pages_against_their_known_text(spark):
    """Pages written around known articles in several templates: the text comes back whole and alone."""
    r = random.Random(10)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 9)))
    said = lambda n: " ".join(word() for _ in range(n))
    templates = [
        "<body><header><h1>{menu}</h1></header><nav><ul><li><a href=/>{menu}</a></li></ul></nav><main><article>{body}</article></main><aside>{menu}</aside><footer>{menu}</footer></body>",
        "<body><div id=top class=menu><a href=/>{menu}</a></div><div class='wrap'><div class='post-{n} content'>{body}</div><div class='sidebar'>{menu}</div></div><div class=footer>{menu}</div><script>var x = '<p>{menu}</p>'</script></body>",
        "<body><table><tr><td class=nav><a href=x>{menu}</a><td class=text>{body}<form><input value='{menu}'><label>{menu}</label></form></table><div class=comments><p>{menu}</p></div></body>",
    ]
    rows, want = [], {}
    for i in range(60):
        blocks = [said(r.randint(3, 9))] + [said(r.randint(20, 90)) + r.choice(["", " & more", " < less"]) for _ in range(r.randint(2, 6))]
        tags = ["h1"] + [r.choice(["p", "p", "blockquote", "li"]) for _ in blocks[1:]]
        body = "\n".join(f"<{t}>{html.escape(b).replace(' ', r.choice([' ', '  ', chr(10)]), 1)}</{t}>" for t, b in zip(tags, blocks))
        rows.append((i, f"http://h{i % 3}.example/{i}", templates[i % 3].format(menu=said(4), n=i, body=body)))
        want[i] = "\n".join(blocks)
    got = {x.page_id: x.text for x in op2_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_headline_outside_the_inner_container_stays(spark):
    body = SAID.replace("<h1>The headline</h1>", "") * 8
    want = "The headline\n" + "\n".join(SAID_TEXT.split("\n")[1:] * 8)
    pages = [
        f"<article><h1>The headline</h1><div class='entry-content'>{body}</div></article>",
        f"<article><div><h1>The headline</h1></div><div><div class='text'>{body}</div></div></article><div><a href=x>Other pages</a></div>",
        f"<main><h1>The headline</h1><article>{body}</article></main>",
        f"<h1>The headline</h1><div class='content'>{body}</div>",
    ]
    for page in pages:
        assert main_of(f"<html><body>{page}</body></html>") == want, page
    assert main_of(f"<html><body><div class='content'>{SAID}</div><div><a href=x>{'Other pages ' * 5}</a></div></body></html>") == SAID_TEXT
    rows = [(i, "http://one.example/", f"<html><body>{pages[0]}</body></html>") for i in range(3)]
    assert {r.text for r in op2_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {want}


def test_quality(odd, none):
    def brute(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        w3 = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        c = Counter(w3)
        rep = {i + k for i, g in enumerate(w3) if c[g] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), sum((t or "").count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep)

    got = op3_quality.judge(odd, ["doc_id", "text"]).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    assert op3_quality.judge(none).count() == 0 and op3_quality.kept_documents(odd).columns == odd.columns


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    d = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(t)] + [(m.start(), m.end(), "ip") for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), m.end(), "card") for m in CARD.finditer(t) if 12 <= len(d(m[0])) <= 19 and op4_pii.luhn(d(m[0]))] + [(m.start(), m.end(), "phone") for m in PHONE.finditer(t) if 9 <= len(d(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], op4_pii.BASE.index(s[2])))


def test_base_spans():
    r = random.Random(3)
    for _ in range(4000):
        s = "".join(r.choice("a1.@+- ()9255%b\n") for _ in range(r.randint(0, 40)))
        assert op4_pii.base_spans(s) == brute_spans(s)


def test_field_on_held_out_lines():
    field, hit, found, real = op4_pii.trained(), 0, 0, 0
    for t, spans in op4_pii.examples(300, 77):
        got = set()
        for a, b in op4_pii.islands(t):
            n, seg = op4_pii.candidates(t, a, b)
            got |= {(seg[k][2], seg[k][3], op4_pii.KINDS[y]) for k, y in field.decode(n, seg)}
        hit, found, real = hit + len(got & set(spans)), found + len(got), real + len(spans)
    assert hit / found > 0.95 and hit / real > 0.95


def test_long_entities_are_found_whole():
    field = op4_pii.trained()
    found = lambda t: {(t[s:e], k) for s, e, k in op4_pii.all_spans(t, field)[1]}
    codes = ["GB82 WEST 1234 5698 7654 32", "IE29 AIBK 9311 5212 3456 78", "NL91 ABNA 0417 1643 00", "SC18 SSCB 1101 0000 0000 0000 1497 USD", "RU03 0445 2522 5408 1781 0538 0913 1041 9"]
    for code in codes:
        assert op4_pii._mod97(code.replace(" ", ""))
        for text in (f"please pay to iban {code}, thanks", f"account {code}", f"the sum goes to {code} today"):
            assert (code, "iban") in found(text), text
    # Wherever a window of a long line ends, what lies there is found whole.
    for code, kind in ((codes[0], "iban"), ("+47 555 123 4567", "phone"), ("123-45-6789", "id")):
        for n in range(20, 140, 3):
            line = "row x25 " + "x1,y2 " * n + code + " x1,y2" * 150
            assert (code, kind) in found(line), (code, n)
    key = "aB3-x9Q_k2Z-p7R_m4T-w8Y_c5V-d6S_f1G-h3J_n0L"
    assert (key, "secret") in found(f"the token: {key} is secret")
    assert ("123-45-6789", "id") in found("unit AB12 SSN 123-45-6789 here")
    r = random.Random(3)
    for n in (24, 190, 201, 400, 5000):
        for letters in ("abcXYZ0123456789", "abcXYZ0123456789_", "abcXYZ0123456789-"):
            key = "aB3" + "".join(r.choice(letters) for _ in range(n - 4)) + "x"
            assert (key, "secret") in found(f"the api key {key} was given"), key
    hand = [  # lines written by hand, with what stands in them
        ("Call me on (555) 010-4477 or write to jo.doe@mail.example.org", {("(555) 010-4477", "phone"), ("jo.doe@mail.example.org", "email")}),
        ("Server 192.168.4.20 went down on 2024-03-05 at 12:30:11", {("192.168.4.20", "ip")}),
        ("Order 4417 of 12 boxes, 3,400 pieces at 19.99 each", set()),
        ("My SSN is 078-05-1120.", {("078-05-1120", "id")}),
        ("Password: 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822c was leaked", {("9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822c", "secret")}),
        ("Pay with 4111 1111 1111 1111 today", {("4111 1111 1111 1111", "card")}),
        ("Version 2.10.4 of the paper, pages 113-128", set()),
        ("Bitte auf DE89 3704 0044 0532 0130 00 zahlen", {("DE89 3704 0044 0532 0130 00", "iban")}),
    ]
    for text, want in hand:
        assert found(text) == want, text


def test_personal_data(odd, none):
    got = {r.doc_id: r for r in op4_pii.find_personal_data(odd).collect()}
    assert (got[9].n_email, got[9].n_ip, got[9].n_card, got[9].n_phone) == (1, 1, 1, 1) and got[0].spans == ""
    clean = {r.doc_id: r for r in op4_pii.redacted(odd).collect()}
    assert clean[9].text == "[EMAIL] [PHONE] and [CARD] at [IP]" and clean[9].n_chars == len(clean[9].text) and clean[8].text == LONG
    assert op4_pii.find_personal_data(none).count() == 0


def test_chat(spark):
    u, a = "user", "assistant"
    turns = [(1, 0, u, "q"), (1, 1, a, "long answer"), (2, 0, u, "q"), (2, 1, a, "short"), (2, 1, a, "short"), (3, 0, u, "other"), (3, 1, a, "x"), (None, 0, u, "lost"), (4, 0, None, None)]
    rows = {r.chosen_id: r for r in op5_chat.formatted(op5_chat.paired(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))).collect()}
    assert set(rows) == {1, 3, 4}
    r = rows[1]
    assert (r.rejected_id, r.n_common_turns, r.prompt) == (2, 1, "<|im_start|>user\nq<|im_end|>\n")
    for text, mask, said in ((r.chosen, r.chosen_mask, ["long answer"]), (r.rejected, r.rejected_mask, ["short", "short"])):  # a repeated row is a repeated turn
        assert [text[s:e] for s, e in (map(int, x.split(":")) for x in mask.split(","))] == [x + "<|im_end|>" for x in said]
    assert rows[4].rejected is None
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op5_chat.formatted(op5_chat.paired(empty)).count() == 0


def brute_pairs(turns):
    """What ``paired`` and ``formatted`` are to give, one conversation after the other."""
    convs = {}
    for conv, turn, role, text, *_ in turns:
        if conv is not None:
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(t)] for c, t in convs.items()}
    opening = lambda c: hashlib.md5("\x1f".join(convs[c][0]).encode()).hexdigest()
    order = sorted(convs, key=lambda c: (opening(c), c))
    said = lambda c: sum(len(x) for r, x in convs[c] if r == "assistant")
    out, at = [], 0
    while at < len(order):
        a = order[at]
        if at + 1 < len(order) and opening(order[at + 1]) == opening(a):
            x, y = sorted((a, order[at + 1]), key=lambda c: (-said(c), c))
            out.append((x, convs[x], y, convs[y]))
            at += 2
            continue
        lender = order[(at + 1) % len(order)]
        mine, theirs = ([i for i, (r, _) in enumerate(convs[c]) if r == "assistant"] for c in (a, lender))
        if mine and theirs and lender != a:
            out.append((a, convs[a], lender, [*convs[a][: mine[-1]], ("assistant", convs[lender][theirs[-1]][1])]))
        else:
            out.append((a, convs[a], None, None))
        at += 1
    shown = lambda t: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in t)
    rows = []
    for x, a, y, b in out:
        k = 0
        while b is not None and k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        rows.append((x, y, k, shown(a[:k]), shown(a[k:]), b and shown(b[k:])))
    return rows


def test_pairs_against_brute_force(spark):
    r = random.Random(7)
    turns = [(c, k, r.choice(["user", "assistant", None]), r.choice(["a", "bb", "ccc", None, ""]), "x", k) for c in range(120) for k in range(r.randint(1, 4))]
    turns += [(c, 0, "user", "the same first turn", "x", 1) for c in range(200, 300)] + [(c, 1, "assistant", "w" * (c % 7), "x", 1) for c in range(200, 300)]
    turns += turns[:15] + [(None, 0, "user", "lost", "x", 0)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, opening string, position int")  # clashing names
    got = op5_chat.formatted(op5_chat.paired(table.repartition(4))).collect()
    assert Counter((x.chosen_id, x.rejected_id, x.n_common_turns, x.prompt, x.chosen, x.rejected) for x in got) == Counter(brute_pairs(turns))


def test_counts(odd, none):
    tok = load("byte_bpe_50k.json")
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in op6_counts.count_tokens(odd).collect())
    want = Counter()
    for r in odd.collect():
        n = len(tok.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 1024] += 1
    assert got == want and op6_counts.count_tokens(none).count() == 0


def test_long_words_are_counted_as_the_library_does():
    own, tok, r = op6_counts.PairRanks("byte_bpe_50k.json"), load("byte_bpe_50k.json"), random.Random(6)
    words = ["".join(r.choice(letters) for _ in range(n)) for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "x", "éaΩ") for n in (0, 1, 200, 255, 257, 3000)]
    words.append("".join(r.choice("etaoinshrdlu") for _ in range(200_000)))
    assert op6_counts.merged_counts(words, own).tolist() == [len(tok.encode(w, add_special_tokens=False).ids) for w in words]


def test_shards(odd, none, tmp_path, spark):
    for n in (1, 2, 3, 17, 1000):
        assert sorted(op7_shards.permuted(np.arange(n), n, 5)) == list(range(n))
    got = op7_shards.assign_shards(odd, 5).collect()
    raw = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len(x) + 8, zlib.crc32(x)) for d, x in raw)
    rows = sorted(((d, zlib.crc32(x), len(x) + 8) for d, x in raw), key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))
    places = op7_shards.permuted(np.arange(len(rows)), len(rows), 20240).tolist()
    assert Counter((r.doc_id, r.text_crc32, r["shard"], r.slot) for r in got) == Counter((d, c, p % 5, p // 5) for (d, c, _), p in zip(rows, places))
    by = Counter(r["shard"] for r in got)
    assert max(by.values()) - min(by.values()) <= 1
    for k in by:
        assert sorted(r.slot for r in got if r["shard"] == k) == list(range(by[k]))
    assert all(r.grown_shard is None and r.law == "rows" for r in got) and op7_shards.assign_shards(none).count() == 0
    op7_shards.write_shards(none.drop("position"), str(tmp_path / "none"), 5)
    assert not list((tmp_path / "none").glob("shard=*"))
    op7_shards.write_shards(odd.drop("position"), str(tmp_path / "s"), 5)
    assert spark.read.parquet(str(tmp_path / "s")).count() == odd.count()


def test_packing(odd, none):
    rows = op8_packing.pack(odd, capacity=64).collect()
    tok = load("word_bpe_49k.json")
    want = Counter()
    for r in odd.collect():
        ids = np.asarray([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((r.doc_id, k // 64, k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64].tobytes())) for k in range(0, len(ids), 64))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert by.get(r.sequence_id, 0) == r.offset
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 64 and op8_packing.pack(none).count() == 0


def test_search_empties_bins():
    h = {6: 2, 5: 2, 4: 2, 3: 2, 2: 2}  # 40 in bins of 10
    assert sum(op8_packing.local_search(op8_packing.best_fit(h, 10), 10).values()) == 4
    r = random.Random(2)
    for _ in range(60):
        cap = r.randint(10, 60)
        h = dict(Counter(r.randint(1, cap) for _ in range(r.randint(1, 60))))
        first = op8_packing.best_fit(h, cap)
        bins = op8_packing.local_search(first, cap)
        have = Counter()
        for kind, n in bins.items():
            assert op8_packing.fill(kind) <= cap
            for a, k in kind:
                have[a] += k * n
        assert have == h and sum(bins.values()) <= sum(first.values())


def helps(a, b, capacity):
    """Whether one piece of a for none, one or two of b, or two for one, makes b fuller and the squared fill larger."""
    one = lambda k: [(x,) for x, _ in k]
    two = lambda k: [(x, y) for x, n in k for y, _ in k if x != y or n > 1]
    fa, fb = op8_packing.fill(a), op8_packing.fill(b)
    for gives, takes in ((one(a), [(), *one(b), *two(b)]), (two(a), one(b))):
        for d in (sum(g) - sum(t) for g in gives for t in takes):
            if 0 < d <= capacity - fb and (fa - d) ** 2 + (fb + d) ** 2 > fa**2 + fb**2:
                return True
    return False


def test_search_ends_where_no_exchange_helps():
    r = random.Random(6)
    many = dict(Counter(min(4096, int(r.lognormvariate(7.3, 0.6)) + 1) for _ in range(3000)))
    small = [(dict(Counter(r.randint(5, 60) for _ in range(r.randint(20, 90)))), 100) for _ in range(30)]
    for first, capacity in [(op8_packing.best_fit(h, c), c) for h, c in [(many, 4096), *small]]:
        pieces = Counter()
        for kind, n in first.items():
            for a, k in kind:
                pieces[a] += k * n
        bins, have = op8_packing.local_search(first, capacity), Counter()
        for kind, n in bins.items():
            assert op8_packing.fill(kind) <= capacity
            for a, k in kind:
                have[a] += k * n
        assert have == pieces and sum(bins.values()) <= sum(first.values())
        if sum(bins.values()) * capacity >= sum(a * n for a, n in pieces.items()) + capacity:
            under = [k for k in bins if op8_packing.fill(k) < capacity]
            assert not any(helps(a, b, capacity) for a in under for b in under if a != b or bins[a] > 1)


def family(r, words, n, edits):
    base = [r.choice(words) for _ in range(120)]
    for _ in range(n):
        own = list(base)
        for _ in range(r.randint(0, edits)):
            own[r.randrange(len(own))] = r.choice(words)
        yield " ".join(own)


def test_near_duplicates(spark, odd, none):
    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = [t for _ in range(4) for t in family(r, words, 40, 8)] + [" ".join(r.choice(words) for _ in range(90)) for _ in range(40)]
    texts += [texts[0].upper()] * 30 + ["", None, "few words", "few  WORDS"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in op9_minhash.near_duplicates(docs).collect()}
    split = [op9_minhash.words_of(t) for t in texts]
    bags = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in split]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            inter, union = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if inter >= 0.8 * union:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(len(texts))}
    assert op9_minhash.near_duplicates(odd).count() == odd.count() and op9_minhash.near_duplicates(none).count() == 0
    assert op9_minhash.representatives(docs).count() == len(set(got.values()))


def test_one_row_of_each_class_stays(spark, odd, none):
    words = lambda seed: " ".join(random.Random(seed).choices([f"w{i}" for i in range(300)], k=60))
    rows = [(7, words(i)) for i in range(20)] + [(None, words(30)), (None, words(30).upper()), (None, words(31)), (8, words(31)), (7, words(3)), (6, words(4) + " end")]
    got = Counter(tuple(r) for r in op9_minhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = [(7, words(i)) for i in range(20) if i != 4] + [(6, words(4) + " end"), (None, min(words(30), words(30).upper(), key=lambda t: hashlib.md5(t.encode()).digest())), (8, words(31))]
    assert got == Counter(want)
    kept = op9_minhash.representatives(odd)
    texts = [TEXTS[0], *TEXTS[3:6], *TEXTS[7:], "another text with the id five"]
    assert Counter(r.text for r in kept.collect()) == Counter(texts) and kept.columns == odd.columns
    assert op9_minhash.representatives(none).count() == 0


def test_hubs_copies_and_shared_ids(spark):
    """A class of many links and copies, ids that many texts share, rows that are repeated: classes and kept rows as by brute force."""
    r = random.Random(12)
    words = [f"w{i}" for i in range(200)]
    base = r.choices(words, k=80)
    near = [" ".join([*base[:i], "x", *base[i + 1 :]]) for i in range(80)]
    other = [" ".join(r.choices(words, k=30)) for _ in range(60)]
    rows = [(5, t) for t in near] + [(9, other[0])] * 150 + [(None, other[1])] * 100 + [(i, t) for i, t in enumerate(other, 100)] + [(5, t) for t in other]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((x.doc_id, x.class_id) for x in op9_minhash.near_duplicates(docs).collect())
    least = {t: min(d for d, x in rows if x == t and d is not None) for t in other}
    assert got == Counter((d, least.get(t, 5)) for d, t in rows)
    kept = op9_minhash.representatives(docs).collect()
    assert len(kept) == 61 and {x.text for x in kept} - set(near) == set(other) and {x.doc_id for x in kept} == {5}


def test_signatures_are_unbiased():
    r = np.random.default_rng(4)
    est, want = [], []
    for _ in range(40):
        keys = np.sort(r.choice(1 << 60, 60, replace=False).astype(np.uint64))
        a, b = r.integers(0, 6, 60), r.integers(0, 6, 60)
        s = op9_minhash.signatures([(keys[a > 0], a[a > 0]), (keys[b > 0], b[b > 0])], 256)
        est.append((s[0] == s[1]).mean())
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(est) - np.mean(want)) < 0.015


def test_leaks(spark, odd, none, monkeypatch):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 8)))
    items = [" ".join(word() for _ in range(r.randint(8, 40))) for _ in range(20)] + ["tiny", "", None]
    docs, want = [], set()
    for i, t in enumerate(items[:20]):
        s = list(op10_decontaminate.normal(t))
        for _ in range(int(op10_decontaminate.Index.of([(0, t)], 0.1).budgets[0])):
            p = r.randrange(len(s))
            s[p : p + 1] = r.choice([[], [r.choice("abc")], [s[p], "z"]])
        docs.append((i, " ".join(word() for _ in range(60)) + " " + "".join(s).title() + "\n" + " ".join(word() for _ in range(30))))
        docs.append((100 + i, " ".join(word() for _ in range(100)) + " " + t[: len(t) // 2]))
        want.add((i, i))
    docs.append((300, " TINY "))
    want.add((300, 20))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in op10_decontaminate.find_leaks(d, b).collect()} == want
    assert op10_decontaminate.clean_documents(d, b).count() == len(docs) - len({x for x, _ in want})
    assert op10_decontaminate.find_leaks(odd, b).count() == 0 and op10_decontaminate.find_leaks(none, b).count() == 0
    assert op10_decontaminate.find_leaks(d, b.limit(0)).count() == 0
    nameless = b.withColumn("item_id", F.when(F.col("item_id") != 20, F.col("item_id"))).withColumn("doc_id", F.lit("x"))
    assert Counter((x.doc_id, x.item_id) for x in op10_decontaminate.find_leaks(d.withColumn("item_id", F.lit(1)), nameless).collect()) == Counter((x, None if y == 20 else y) for x, y in want)
    texts = [op10_decontaminate.normal(t) for _, t in docs]
    index = op10_decontaminate.Index.of([(i, op10_decontaminate.normal(t)) for i, t in enumerate(items) if t], 0.1)
    whole = sorted(op10_decontaminate.occurrences(texts, index))
    monkeypatch.setattr(op10_decontaminate, "_POSTINGS", 5)
    assert sorted(op10_decontaminate.occurrences(texts, index)) == whole
    assert op10_decontaminate.clean_documents(odd, b).columns == odd.columns


def test_distance_against_the_full_table():
    r = random.Random(5)
    for _ in range(300):
        a = "".join(r.choice("abc") for _ in range(r.randint(8, 20)))
        t = "".join(r.choice("abc") for _ in range(r.randint(5, 40)))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, x in enumerate(t, 1):
                last, row[j] = row[j], min(last + (c != x), row[j] + 1, row[j - 1] + 1)
        k = r.randint(0, 4)
        got = op10_decontaminate.banded_distance(a, t, -k, len(t), k)
        assert (got[0] if got else None) == (min(row) if min(row) <= k else None)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
    kept = op3_quality.judge(docs).filter(F.col("kept")).count()
    assert corpus_pipeline.quality(spark, docs, "").count() == kept
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0, name


def test_pipeline_runs_whole(spark, tmp_path):
    """run() against a composition of its stages by brute force, with shared ids, no ids, copies and leaks."""
    import corpus_pipeline

    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = [r for r in op3_quality.kept_documents(given).collect()][:40]
    rows = [r.asDict() for r in kept] + [kept[0].asDict() | {"doc_id": kept[1].doc_id, "text": kept[5].text.upper() + " a b c"}]
    rows += [kept[2].asDict() | {"doc_id": None}, kept[3].asDict()]
    rows += [r.asDict() | {"doc_id": kept[6].doc_id} for r in kept[6:12]]
    for r in rows[12:16]:
        r["doc_id"] = None
    item = " ".join(kept[20].text.split()[10:30])
    spark.createDataFrame(rows, given.schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    rows = [r.asDict() for r in op3_quality.kept_documents(spark.createDataFrame(rows, given.schema)).collect()]
    bags = []
    for r in rows:
        w = r["text"].lower().split()
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))))
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                root = [root[j] if x == root[i] else x for x in root]
    order = lambda i: (rows[i]["doc_id"] is None, rows[i]["doc_id"], op9_minhash.key_of(op9_minhash.words_of(rows[i]["text"])), rows[i]["text"])
    stay = [rows[min((i for i in range(len(rows)) if root[i] == c), key=order)] for c in set(root)]
    clean = [r for r in stay if op10_decontaminate.normal(item) not in op10_decontaminate.normal(r["text"])]
    assert len(rows) > len(stay) > len(clean) > 20
    field, tok, want = op4_pii.trained(), load("word_bpe_49k.json"), Counter()
    for r in clean:
        ids = np.asarray([*tok.encode(op4_pii.masked(r["text"], op4_pii.all_spans(r["text"], field)[1]), add_special_tokens=False).ids, 1], "<u4")
        want.update((r["doc_id"], k // 4096, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())) for k in range(0, len(ids), 4096))
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == want
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset and r.offset + r.length <= 4096
        ends[r.sequence_id] = r.offset + r.length


def test_shards_and_sequences_written_from_skewed_rows(spark, tmp_path):
    r = random.Random(3)
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, " ".join(r.choice("ab cd ef gh".split()) for _ in range(r.randint(0, 60)))) for i in range(300)]
    rows += [(7, "the same")] * 90 + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    op7_shards.write_shards(docs, str(tmp_path / "s"), 7)
    files = spark.read.parquet(str(tmp_path / "s")).collect()
    size = lambda x: (x.doc_id, len((x.text or "").encode()) + 8, zlib.crc32((x.text or "").encode()), x["shard"], x.slot)
    planned = Counter((x.doc_id, x["size"], x.text_crc32, x["shard"], x.slot) for x in op7_shards.assign_shards(docs, 7).collect())
    assert Counter(map(size, files)) == planned and Counter((x.doc_id, x.text) for x in files) == Counter(rows)

    tok = load("word_bpe_49k.json")
    want = Counter()
    for d, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.update((d, tuple(ids[k : k + 32])) for k in range(0, len(ids), 32))
    got = Counter()
    for x in op8_packing.sequences(docs, capacity=32).collect():
        assert len(x.ids) <= 32 and x.offsets[0] == 0
        got.update((d, tuple(x.ids[a:b])) for d, a, b in zip(x.doc_ids, x.offsets, [*x.offsets[1:], len(x.ids)]))
    assert got == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_recall_on_the_documents(spark):
    """Every pair of the small corpus that is similar, by brute force over shared shingles, is in one class; and nothing else is."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    bags, held = {}, {}
    for r in docs:
        w = op9_minhash.words_of(r.text)
        bags[r.doc_id] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
        for g in bags[r.doc_id] or [None]:
            held.setdefault(g, []).append(r.doc_id)
    pairs = {(a, b) for ids in held.values() for i, a in enumerate(ids) for b in ids[:i]}
    close = []
    for a, b in pairs:
        inter, union = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
        if inter >= 0.8 * union:
            close.append((a, b))
    root = {r.doc_id: r.doc_id for r in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in close:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.class_id for r in op9_minhash.near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    near = [(a, b) for a, b in close if bags[a] != bags[b]]
    found = sum(got[a] == got[b] for a, b in near)
    assert near and found >= 0.99 * len(near), (found, len(near))
    assert all(find(i) == find(c) for i, c in got.items())
