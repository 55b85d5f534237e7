"""Each operator against a brute-force version, and the defined corner cases."""

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import bpe, chat, common, html_text, near_dup, quality_rules, substring, tiling, token_file, toxicity, warc

from ..conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, g, None, len(t or "")) for i, t, g in zip(ids, texts, langs)], DOCS)


def by_id(df, key="doc_id"):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r.asDict())
    return {k: v[0] if len(v) == 1 else v for k, v in out.items()}


def sample(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def texts_of(spark):
    return {r["doc_id"]: r["text"] or "" for r in sample(spark).select("doc_id", "text").collect()}


ODD = [None, "", " \t\n", "x", "é ü  b\x85c", "a b c d", "a b c d e f a b c d e f a b c d e f", "one\n\none\n one\n", "ß" * 5000, None, ""]


# --- 1 chat ---------------------------------------------------------------------------
def test_chat_round_trip_and_order(spark):
    evil = ["\\### Assistant: </turn> ok", "#### Assistant: <says>\\0;", "### ### </turn></turn>", "\\\\", None, ""]
    turns = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(evil)]
    turns += [(2, 0, "assistant", "x"), (2, 1, None, "y"), (2, 1, "odd </turn> role", "z"), (None, 0, "user", "n"), (3, None, "user", "first"), (3, 0, "assistant", "b")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as segment", "2 as kind")
    seg = chat.format_conversations(df)
    got = by_id(chat.read_back(seg), "conv_id")
    for conv in (1, 2, 3, None):
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: ((t[1] is not None, t[1] or 0), t[2] or "", t[3] or ""))
        h, loss = hashlib.sha256(), "".join(t[3] or "" for t in own if t[2] == "assistant")
        for t in own:
            h.update(f"{t[2] or ''}\n{t[3] or ''}\n".encode())
        assert got[conv]["n_turns"] == len(own) and got[conv]["turns_sha256"] == h.hexdigest()
        assert got[conv]["loss_chars"] == len(loss) and got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert got[1]["n_violations"] == 0 and got[2]["n_violations"] >= 2 and got[3]["n_violations"] == 0
    for r in seg.where("kind = 'text'").collect():
        assert not any(c in r["segment"] for c in chat.Template().control)
    assert got[1]["formatted_chars"] == sum(len(r["segment"]) for r in seg.where("conv_id = 1").collect())


def test_chat_template_is_checked_and_empty_table(spark):
    with pytest.raises(ValueError):
        chat.Template(control=("\\x",))
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(empty)).count() == 0


# --- 2 near duplicates ------------------------------------------------------------------
def brute_components(texts):
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(lower))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    post, parent = collections.defaultdict(list), {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in sorted(texts):
        common_n = collections.Counter(j for s in sets[i] for j in post[s])
        for j, c in common_n.items():
            if 100 * c >= 85 * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            post[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in texts}


def near_copies(seed, bases=6, copies=25):
    r, out = random.Random(seed), []
    for _ in range(bases):
        base = [f"w{r.randrange(10**6)}" for _ in range(r.choice([30, 120, 300]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randrange(0, 1 + len(w) // 25)):
                w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
            out.append(" ".join(w).upper() if r.random() < 0.2 else "  ".join(w))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("block", [near_dup.BLOCK_SHINGLES, 700])
def test_near_duplicates_equal_brute_force(spark, block):
    texts = dict(enumerate(near_copies(5) + ODD + list(texts_of(spark).values())[:60]))
    want = brute_components(texts)
    got = by_id(near_dup.components(rows(spark, list(texts.values())), block=block))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_odd_ids(spark):
    base = " ".join(f"a{i}" for i in range(40))
    got = near_dup.components(rows(spark, [base, base, base, "p q r s t u", base + " z"], ids=[5, 5, None, 7, 9])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"]) for r in got) == [(False, 5, 5), (False, 5, 5), (False, 7, 7), (False, 9, 5), (True, 0, None)]
    assert near_dup.components(rows(spark, [])).count() == 0
    kept = near_dup.keep_one(rows(spark, [base, base, base, "p q r s t u", base + " z"], ids=[5, 5, None, 7, 9])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, 5), (False, 7), (True, 0)]


def test_connected_components_of_a_long_chain(spark):
    n = 300
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


# --- 3 html ---------------------------------------------------------------------------
@pytest.mark.parametrize("page,text", [
    ("<p>a<p>b", "a\n\nb"), ("a<br>b", "a\nb"), ("<div>a</div><div>b</div>", "a\nb"), ("<b>a</b> <i>b</i>c", "a bc"),
    ("<ul><li>a<li>b<ol><li>c</ol></ul>", "- a\n- b\n  1. c"), ("<ol start=4><li>x</ol>", "4. x"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><td>a<td colspan=2>long cell<tr><td>x<td>y<td>z</table>", "a  long cell\nx  y  z"),
    ("<pre>\n a\n  b</pre>", " a\n  b"), ("<p hidden>x</p>y", "y"), ("<p style='display:none'>x</p>y", "y"), ("<script>a<b</script>z", "z"),
    ("<!-- x -->a &amp; &lt;b&gt; &copy", "a & <b> ©"), ("", ""), (None, ""), ("2 < 3 and 4 > 1", "2 < 3 and 4 > 1"), ("</p>a</div></b>", "a"),
    ("<title>t</title><body>b", "b"), ("<p>a</p>\n\n\n<p>  b  c </p>", "a\n\nb c"), ("<blockquote>q</blockquote>", "> q"),
])
def test_html_rendering(page, text):
    assert html_text.render(page) == text


def test_html_table(spark):
    assert html_text.render("<div>" * 5000 + "deep" + "</div>" * 5000).strip() == "deep"
    df = spark.createDataFrame([(1, "<p>a"), (None, None), (1, "<p>b"), (2, "")], "page_id long, html string").selectExpr("*", "9 as text", "8 as n_chars")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.extract(df).collect()) == [(0, "", 0), (1, "a", 1), (1, "b", 1), (2, "", 0)]
    # all visible words of a page come out, in order
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").limit(20).collect():
        plain = re.sub(r"(?s)<(script|style|title)>.*?</\1>|<!--.*?-->", " ", r["html"])
        import html as h
        want = re.sub(r"\s", "", h.unescape(re.sub(r"<[^>]*>", " ", plain)))
        got = re.sub(r"\s", "", re.sub(r"(?m)^(- |\d+\. )", "", html_text.render(r["html"])))
        assert got == want


@pytest.mark.parametrize("page,text", [
    ("<span>" * 400 + "<div style='display:none'><p>no</p></div>yes", "yes"),
    ("<b>" * 400 + "<ul><li>a<li>b</ul>", "- a\n- b"),
    ("<div>" * 400 + "<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<div hidden>" + "<font>" * 400 + "<div>no</div>no</div>yes", "yes"),
    ("<blockquote>" * 200 + "q", "> " * 200 + "q"),
    ("<div>" * 30000 + "<p hidden>no</p>a<br>" + "<b><i>b</i>" * 30000, "a\n" + "b" * 30000),
])
def test_html_deep_nesting(page, text):
    assert html_text.render(page) == text


def plain_layout(node, parent="", keep=False):
    """Lines of a tree by plain recursion: every level lays out its lines anew. A tree is (tag, kids) or a text."""
    out, line, state = [], [], {"space": False, "gap": 0}

    def put(w):
        if not line and state["gap"]:
            out.extend([""] * (state["gap"] - 1 if out else 0))
            state["gap"] = 0
        line.extend([" "] if state["space"] and line and not line[-1].endswith(" ") else [])
        line.append(w)
        state["space"] = False

    def newline():
        out.append("".join(line).rstrip(" "))
        line.clear()
        state["space"] = False

    def block(gap):
        if line:
            newline()
        state.update(gap=max(state["gap"], gap), space=False)

    def walk(tag, kids, parent):
        number = 1
        for k in kids:
            if isinstance(k, str):
                for i, w in enumerate(re.split(r"[ \t\n\r\f]+", k)):
                    state["space"] |= i > 0
                    if w:
                        put(w)
                continue
            t, inner = k
            if t == "br":
                newline()
            elif t == "li" and tag in ("ul", "ol"):
                mark = f"{number}. " if tag == "ol" else "- "
                number += 1
                for i, x in enumerate(plain_layout(k) or [""]):
                    block(1)
                    if x or not i:
                        put((mark if not i else " " * len(mark)) + x)
            else:
                gap = 0 if t in ("b", "i") else 1 if t in ("div", "li") or (t in ("ul", "ol") and tag == "li") else 2
                if gap:
                    block(gap)
                if t == "blockquote":
                    for x in plain_layout(k):
                        block(1)
                        put("> " + x)
                else:
                    walk(t, inner, tag)
                if gap:
                    block(gap)

    walk(node[0], node[1], parent)
    if line:
        newline()
    while out and not out[-1]:
        out.pop()
    return out


@pytest.mark.parametrize("seed", range(6))
def test_html_layout_equals_plain_recursion(seed):
    r = random.Random(seed)

    def tree(depth):
        kids = []
        for _ in range(r.randrange(4)):
            if depth == 0 or r.random() < 0.4:
                kids.append(r.choice(["a", " b ", "cc  dd", " ", "e\nf", ("br", [])]))
            else:
                t = r.choice(["div", "p", "b", "i", "ul", "ol", "li", "blockquote"])
                kids.append((t, tree(depth - 1)))
        return kids

    def source(kids):
        return "".join(k if isinstance(k, str) else "<br>" if k[0] == "br" else f"<{k[0]}>{source(k[1])}</{k[0]}>" for k in kids)

    def legal(kids, above=()):
        """No element that the tree builder would close at another one's start."""
        return all(isinstance(k, str) or k[0] == "br" or (not (k[0] not in ("b", "i") and "p" in above)
                   and not (k[0] == "li" and "li" in above[max([-1, *[i for i, t in enumerate(above) if t in ("ul", "ol")]]) + 1:])
                   and legal(k[1], (*above, k[0]))) for k in kids)

    done = 0
    while done < 400:
        kids = tree(r.randrange(1, 7))
        if legal(kids):
            done += 1
            assert html_text.render(source(kids)) == "\n".join(plain_layout(("", kids))), source(kids)


@pytest.mark.parametrize("part,shape", [
    ("<a ", "same"), ("<a \"'", "same"), ("<a '<b \"", "same"), ("<blockquote>x", "> x\n>\n> > x\n"), ("<ul><li>x", "- x\n  - x\n"), ("<table><tr><td>x", ""), ("<div><br>", ""), ("<p><li>", ""),
    ("<td colspan=1000>x", ""),
])
def test_html_time_and_size_grow_with_the_page(part, shape):
    import time
    seconds = []
    for n in (50_000, 400_000):
        page = part * (n // len(part))
        at = time.process_time()
        text = html_text.render("<table>" + page if part.startswith("<td") else page)
        seconds.append(time.process_time() - at)
        assert len(text) <= 100 * n
        if shape == "same":
            assert text == page.strip()
        elif "x" in part:
            assert text.count("x") == page.count("x")
        if shape and shape != "same":
            assert text.startswith(shape)
    assert seconds[1] < 30 * max(seconds[0], 0.02)  # eight times the page; a square would be 64


def test_html_wide_table_and_tags_that_never_end():
    page = "<table><tr>" + "<td>x" * 20_000 + "<br>a" * 20_000
    text = html_text.render(page)
    assert text.count("x") == 20_000 and text.count("a") == 20_000 and len(text) < 70 * len(page) + (1 << 18)
    assert html_text.render("a <b title='x>y'>c</b> <i title='d") == "a c <i title='d"
    assert html_text.render("<a 'q> <b>c</b> d") == "<a 'q> c d"


# --- 4 token files ------------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(6))
def test_simple8b_round_trip(seed):
    g = np.random.default_rng(seed)
    n = [1, 5, 4096, 4097, 65536, 9000][seed]
    wide = g.integers(0, 64, n).astype(np.uint64)
    x = g.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) >> wide
    if seed == 5:
        x[:3000] = 0
        x[4000:4003] = 2**64 - 1
    p = token_file.pack(x)
    assert (token_file.unpack(p) == x).all()
    for b in range(-(-n // token_file.BLOCK_IDS)):
        assert (token_file.unpack(p, b) == x[b * token_file.BLOCK_IDS:(b + 1) * token_file.BLOCK_IDS]).all()
    if seed == 0:
        assert token_file.crc32_join(zlib.crc32(b"ab"), zlib.crc32(b"cde"), 3) == zlib.crc32(b"abcde")


def test_token_file_equals_library(spark, scratch):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    texts = ODD + ["<|endoftext|> it's we'll  \n\n x", "zq " * 60_000, "\x1c a\x85 b\u00a0\u00a0c’s ½ 𝒳"] + list(texts_of(spark).values())[:80]
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    token_file.write_token_file(rows(spark, texts, ids), scratch, P.path("byte_bpe_50k.json"))
    got = by_id(token_file.read_token_file(spark, scratch))
    start = 0
    for i, t in sorted(zip(ids, texts)):
        want = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        assert got[i] == {"doc_id": i, "start": start, "n_tokens": len(want), "ids_crc32": zlib.crc32(want.tobytes())}
        start += len(want)


def test_splitter_equals_pattern():
    import regex
    r, split = random.Random(3), token_file.Splitter()
    signs = ["'s", "'re", "'ll", "'l", "'r", "'", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x85", "\x1c", "a", "re", "é", "12", "½", "!!", "日本", "𝒳", "_", "’", "\u0301"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(12))) for _ in range(20_000)]
    data, off = common.text_buffers(pa.array(texts))
    start = split.starts(data, off)
    cut = np.searchsorted(start, off)
    raw, ends = data.tobytes(), np.append(start[1:], len(data))
    find = regex.compile(P.PATTERN).findall
    for i, t in enumerate(texts):
        got = [raw[a:b].decode() for a, b in zip(start[cut[i]:cut[i + 1]], ends[cut[i]:cut[i + 1]])]
        assert got == find(t), repr(t)


def test_token_file_odd_ids_and_empty(spark, scratch):
    token_file.write_token_file(rows(spark, ["b", "a", "c"], [1, 1, None]), scratch, P.path("byte_bpe_50k.json"))
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in token_file.read_token_file(spark, scratch).collect())
    assert got == [(0, None, 2), (2, 1, 2), (4, 1, 2)]
    token_file.write_token_file(rows(spark, []), scratch + "-e", P.path("byte_bpe_50k.json"))
    assert token_file.read_token_file(spark, scratch + "-e").count() == 0


# --- 5 byte-level BPE ----------------------------------------------------------------------
def library():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK_CHARS, bpe.OVERLAP_CHARS), (50, 12), (31, 30), (7, 3)])
def test_bpe_equals_library(spark, chunk, overlap):
    lib, r = library(), random.Random(chunk)
    made = ["".join(r.choice(["'s", " ", "  ", "\n", "a", "Zé", "12", "!!", "'", "\t ", "ll", "日本"]) for _ in range(r.randrange(400))) for _ in range(40)]
    texts = ODD + ["a" * 300 + " b", " " * 200 + "x" + " " * 99, "it's" * 90] + made + list(texts_of(spark).values())[:25]
    got = by_id(bpe.token_digests(rows(spark, texts), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, chunk=chunk, overlap=overlap))
    for i, t in enumerate(texts):
        ids = np.array(lib.encode_ordinary(t or ""), "<u4")
        assert got[i] == {"doc_id": i, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest(),
                          "decoded_sha256": hashlib.sha256((t or "").encode()).hexdigest()}, (i, t)


def test_bpe_odd_ids_and_empty(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    got = bpe.token_digests(rows(spark, ["a", "a b", None], [1, 1, None]), path, P.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 0), (1, 1), (1, 2)]
    assert bpe.token_digests(rows(spark, []), path, P.PATTERN).count() == 0


# --- 6 WARC --------------------------------------------------------------------------------
@pytest.mark.parametrize("chunk", [warc.CHUNK_BYTES, 100, 3])
def test_warc_round_trip(spark, scratch, chunk):
    pages = [(1, "u", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "x\r\ny", None), (4, "v", ""), (9, "w", "z" * 10_001), (5, "w", "z" * 10_001), (7, "t", "\r\n\r\n"), (8, "u", "<p>é</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as _chunk", "2 as payload_bytes")
    warc.write_archive(df, scratch, chunk_bytes=chunk)
    got = by_id(warc.read_archive(spark, scratch), "page_id")
    top = {}
    for i, _, t in pages:
        top[t or ""] = max(i, top.get(t or "", -1))
    for i, _, t in pages:
        b = (t or "").encode()
        assert got[i] == {"page_id": i, "payload_bytes": len(b), "payload_digest": base64.b32encode(hashlib.sha1(b).digest()).decode(),
                          "record_type": "response" if top[t or ""] == i else "revisit", "refers_to": None if top[t or ""] == i else top[t or ""]}


def test_warc_damage_odd_ids_empty(spark, scratch):
    df = spark.createDataFrame([(1, "u", "a" * 500), (1, "u", "a" * 500), (None, "u", "a" * 500)], "page_id long, url string, html string")
    warc.write_archive(df, scratch, chunk_bytes=64)
    got = sorted(((r["page_id"] or 0, r["record_type"]) for r in warc.read_archive(spark, scratch).collect()))
    assert got == [(0, "response"), (1, "response"), (1, "revisit")]
    spark.read.parquet(scratch).where("_chunk <> 8").write.parquet(scratch + "-cut")
    with pytest.raises(Exception, match="chunk"):
        warc.read_archive(spark, scratch + "-cut").collect()
    warc.write_archive(df.limit(0), scratch + "-e")
    assert warc.read_archive(spark, scratch + "-e").count() == 0


# --- 7 quality ------------------------------------------------------------------------------
def brute_counters(text):
    t = text or ""
    w = WORD.findall(t)
    windows = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered), "base_failed": n < 10 or 100 * len(covered) > 20 * n}


def test_quality_counters_equal_brute_force(spark):
    texts = ODD + ["a b c d e\n" * 4, "| x |\n| x |\n\n \n \n"] + list(texts_of(spark).values())
    got = by_id(quality_rules.quality_report(rows(spark, texts, langs=[None, "en"] * (len(texts) // 2) + ["de"] * (len(texts) % 2)).selectExpr("*", "1 as n_words", "2 as kept")))
    for i, t in enumerate(texts):
        want = brute_counters(t)
        assert {k: got[i][k] for k in want} == want, (i, t)
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert quality_rules.quality_report(rows(spark, [])).count() == 0


def test_kneser_ney_sums_to_one_and_equals_a_plain_version():
    data = np.frombuffer(b"the cat sat on the mat. the dog sat on the log. " * 3 + b"a zebra", np.uint8)
    off = np.array([0, 60, len(data)])
    key, row = quality_rules.grams(data, off)
    k, n = np.unique(key, return_counts=True)
    m = quality_rules.Model(k, n)
    ctx = int(k[5]) >> 6
    every = np.arange(64) | ctx << 6
    assert abs(np.exp(m.lookup(every)).sum() - 1) < 1e-3
    assert np.allclose(m.score(data, off), [m.lookup(key[row == i]).sum() for i in (0, 1)])
    # plain counting of the packed grams
    cls = quality_rules.CLASSES
    want = collections.Counter()
    for a, b in zip(off[:-1], off[1:]):
        s = [0, 0, 0] + [int(cls[x]) for x in data[a:b]]
        want.update(s[i] << 18 | s[i + 1] << 12 | s[i + 2] << 6 | s[i + 3] for i in range(b - a))
    assert dict(zip(k.tolist(), n.tolist())) == dict(want)


def test_quality_bands_reject_noise_and_keep_clean(spark):
    r = random.Random(3)
    vocabulary = ["".join(r.choice(["an", "er", "th", "in", "or", "es", "ti"]) for _ in range(r.randrange(1, 4))) for _ in range(300)]
    clean = [" ".join(r.choice(vocabulary) for _ in range(120)) for _ in range(300)]
    noise = [" ".join("".join(r.choice("qzxjkvwy#%&") for _ in range(7)) for _ in range(120)) for _ in range(6)]
    got = by_id(quality_rules.quality_report(rows(spark, clean + noise)))
    assert sum(got[i]["kept"] for i in range(300)) >= 298
    assert not any(got[300 + i]["kept"] for i in range(6))


def prose(seed, texts, words=120):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice(["an", "er", "th", "in", "or", "es", "ti"]) for _ in range(r.randrange(1, 4))) for _ in range(300)]
    return [" ".join(r.choice(vocabulary) for _ in range(words)) for _ in range(texts)]


def test_quality_bands_with_one_text_in_most_rows(spark):
    clean = prose(5, 300)
    near = [clean[0].rsplit(" ", 1)[0] + " " + w for w in prose(6, 1, 400)[0].split()]
    texts = clean[:100] + [clean[0]] * 400 + clean[100:200] + near + clean[200:]
    langs = ["de"] * 500 + ["fr"] * 500 + ["en"] * 100  # one text, or near copies of it, in 80 % of the rows
    got = by_id(quality_rules.quality_report(rows(spark, texts, langs=langs)))
    assert [sum(got[i]["kept"] for i in at) for at in (range(100), range(500, 600), range(1000, 1100))] == [100, 100, 100]


def test_quality_bands_of_rare_languages(spark):
    clean = prose(7, 606)
    r = random.Random(8)
    noise = [" ".join("".join(r.choice("qzxjkvwy#%&") for _ in range(7)) for _ in range(120)) for _ in range(103)]
    langs = ["en"] * 600 + ["yy"] * 5 + [None] + ["n1"] * 3 + ["n49"] * 49 + ["n50"] * 50 + ["x"]
    got = by_id(quality_rules.quality_report(rows(spark, clean + noise, langs=langs)))
    assert all(got[i]["kept"] for i in range(606))
    assert [i for i in range(606, 709) if got[i]["kept"]] == []


# --- 8 substring ------------------------------------------------------------------------------
def brute_removed(texts, window=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out


@pytest.mark.parametrize("group_rows,local", [(substring.GROUP_ROWS, substring.LOCAL_ROWS), (3, 2)])
def test_substring_equals_brute_force(spark, monkeypatch, group_rows, local):
    monkeypatch.setattr(substring, "GROUP_ROWS", group_rows)
    r = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(60):
        w = [f"w{r.randrange(40)}" for _ in range(r.randrange(0, 90))]
        at = r.randrange(len(w) + 1)
        a, n = r.randrange(30), r.choice([0, 34, 35, 36, 60])
        texts.append("  ".join(w[:at] + passage[a:a + n] + w[at:]))
    texts += ["a " * 100, "x y " * 20, "a " * 35, "b " * 34, "a " * 100] + ODD + list(texts_of(spark).values())[:60]
    want = brute_removed(texts)
    df = rows(spark, texts).repartition(5).selectExpr("*", "1 as n_removed", "2 as _pos")
    if group_rows == 3:
        monkeypatch.setattr(substring.repeats, "__defaults__", (35, substring.PREFIXES, 3))
    got = by_id(substring.removal_report(df))
    for i, (n, gone, kept) in enumerate(want):
        assert got[i] == {"doc_id": i, "n_words": n, "n_removed": gone, "kept_sha256": hashlib.sha256(" ".join(kept).encode()).hexdigest()}, i
    spans = collections.Counter()
    for s in substring.maximal_repeats(df).collect():
        spans[s["doc_id"]] += s["end_word"] - s["start_word"]
    assert dict(spans) == {i: g for i, (_, g, _) in enumerate(want) if g}


def test_substring_odd_ids_and_cut(spark):
    p = " ".join(f"p{i}" for i in range(40))
    df = rows(spark, [p, p + " x", "q  r", None], [1, 1, None, 4])
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring.removal_report(df).collect())
    assert got == [(0, 2, 0), (1, 40, 40), (1, 41, 40), (4, 0, 0)]
    cut = substring.cut_repeats(df)
    assert cut.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in cut.collect()) == [(0, "q  r"), (1, ""), (1, "x"), (4, "")]
    assert substring.removal_report(rows(spark, [])).count() == 0


# --- 9 toxicity ---------------------------------------------------------------------------------
def test_deobfuscation_restores_words(spark):
    r = toxicity.Restorer(toxicity.count_trigrams(rows(spark, ["the idiot and the moron met a stupid clown in the trash good food look"] * 5)))
    for text, word in [("you 1d10t!", "idiot"), ("a m0r0n", "moron"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("stuuuuupid", "stupid"),
                       ("$tup1d", "stupid"), ("tr@sh", "trash"), ("c-l-o-w-n", "clown"), ("gooood", "good")]:
        assert word in r.words(text), (text, r.words(text))
    assert r.words("plain words stay") == {"plain", "words", "stay"}
    assert r.words("") == set()


@pytest.fixture(scope="module")
def restorer(spark):
    text = "you are a stupid clown and he is an idiot. the moron met a stupid idiot in the trash, you know. is this an ass or shit? good food for the class"
    return toxicity.Restorer(toxicity.count_trigrams(rows(spark, [text] * 5)))


@pytest.mark.parametrize("text,word", [
    ("so s.t.u.p.i.d.", "stupid"), ("an i-d-i-o-t!", "idiot"), ("an i-d-i-o-t, yes", "idiot"), ("(i-d-i-o-t)", "idiot"), ("$-t-u-p-i-d!", "stupid"),
    ("so i d i o t.", "idiot"), ('"i d i o t"', "idiot"), ("so i-d i-o-t.", "idiot"), ("i, d, i, o, t!", "idiot"),
])
def test_deobfuscation_beside_punctuation(restorer, text, word):
    assert word in restorer.words(text), restorer.words(text)


@pytest.mark.parametrize("text,words", [
    ("you are a i d i o t", ["idiot"]), ("y o u i d i o t", ["you", "idiot"]), ("y.o.u.a.r.e.a.s.t.u.p.i.d.", ["you", "are", "stupid"]),
    (" ".join("youareastupidclown" * 12 + "1d10t"), ["you", "are", "stupid", "clown", "idiot"]),
    ("-".join("youareastupidclown" * 500 + "1d10t"), ["you", "are", "stupid", "clown", "idiot"]),
])
def test_deobfuscation_of_several_words(restorer, text, words):
    assert set(words) <= restorer.words(text), restorer.words(text)


@pytest.mark.parametrize("text,word", [
    ("an a55", "ass"), ("an a$$", "ass"), ("oh shi7", "shit"), ("an idi07", "idiot"), ("oh 5h17", "shit"), ("(5h17)", "shit"),
    ("an 1d107.", "idiot"), ("the 455", "ass"), ("an 1d!07", "idiot"), ("an id!0+", "idiot"),
])
def test_deobfuscation_of_signs(restorer, text, word):
    assert word in restorer.words(text), restorer.words(text)


def lattice_score(r, path):
    """Score of one path of a lattice: channel costs and trigrams, with the end of the word."""
    total, text = sum(w for _, w in path), "".join(x for x, _ in path)
    a = b = 0
    for ch in text:
        z = r._class(ch)
        total, a, b = total + float(r.lm[a, b, z]), b, z
    return total + float(r.lm[a, b, 0]), text


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_equals_all_paths(restorer, seed):
    rand = random.Random(seed)
    for _ in range(60):
        span = "".join(rand.choice("idiots1074@$!+*.-") * rand.choice([1, 1, 1, 2, 3]) for _ in range(rand.randrange(1, 6)))
        if rand.random() < 0.4:
            span = rand.choice(" .-").join(span)
        span = span[:11]
        lattice = restorer._lattice(span)
        scored = [lattice_score(restorer, path) for path in itertools.product(*lattice)]
        best = max(x for x, _ in scored)
        got = restorer._path(lattice)
        assert max(x for x, text in scored if text == got) == pytest.approx(best, abs=1e-4), (span, got)


def test_scores_equal_a_plain_sum_over_features(restorer):
    rand = random.Random(2)
    texts = ["you 1d10t!", "a m0r0n and an i d i o t", "good food, stuuuupid class", "", "plain words stay"]
    names = sorted(set().union(*(restorer.features(t) for t in texts)))
    scorer = toxicity.Scorer({f: rand.uniform(-2, 2) for f in names if rand.random() < 0.6}, -0.7)
    for t in texts:
        z = -0.7 + sum(scorer.weights.get(f, 0.0) for f in restorer.features(t))
        assert scorer.probability(restorer.words(t)) == pytest.approx(1 / (1 + np.exp(-z)))


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    pos, neg = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    auc = ((pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean())
    assert auc > 0.95 and (got.predicted == got.toxic).mean() > 0.95


def test_toxicity_corner_cases(spark):
    docs = rows(spark, ["idiot", None, "", "fine", "fine"], [1, 2, None, 4, 4]).selectExpr("*", "0.5 as score", "1 as toxic")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, none).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = {r["doc_id"]: r["held_out"] for r in got}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in (1, 2, 4)) and held[None] is False
    some = spark.createDataFrame([(1, 1, 1), (4, 1, None), (4, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, some).count() == 5
    assert toxicity.toxicity(docs.limit(0), some).count() == 0


# --- 10 decontamination ---------------------------------------------------------------------------
def brute_tiles(doc, item, k):
    """Greedy string tiling by direct comparison."""
    k = min(k, len(item))
    in_doc, in_item, covered = [False] * len(doc), [False] * len(item), 0
    while k:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not in_doc[i + n] and not in_item[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < k:
            return covered
        in_doc[i:i + n] = [True] * n
        in_item[j:j + n] = [True] * n
        covered += n
    return covered


def test_tiling_equals_brute_force(spark):
    r = random.Random(4)
    items = [[f"t{r.randrange(500)}" for _ in range(r.choice([3, 12, 30]))] for _ in range(12)]
    texts = []
    for i in range(40):
        it = r.choice(items)
        h = len(it) // 2
        body = [f"d{r.randrange(500)}" for _ in range(r.randrange(20))]
        texts.append(" ".join(body + r.choice([it, it[h:] + ["x"] + it[:h], it[:h], it[3:], []]) + body).upper().replace(" ", ", ", 3))
    texts += ODD
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, ""), (52, "...")], "item_id long, text string")
    want = {}
    for d, t in enumerate(texts):
        tok = re.findall("[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())
        want[d] = max((brute_tiles(tok, it, tiling.MIN_MATCH) / len(it) for it in items), default=0)
    for seeds in (tiling.BLOCK_SEEDS, 40):
        got = by_id(tiling.decontaminate(rows(spark, texts).selectExpr("*", "1 as item_id", "2 as kept"), bench, block_seeds=seeds))
        for d in want:
            assert got[d]["coverage"] == pytest.approx(want[d]), (d, texts[d])
            assert got[d]["contaminated"] == (want[d] >= tiling.COVERAGE) != got[d]["kept"]
        kept = {x["doc_id"] for x in tiling.drop_contaminated(rows(spark, texts), bench, block_seeds=seeds).collect()}
        assert kept == {d for d in want if want[d] < tiling.COVERAGE}


def test_tiling_with_common_openings(spark, monkeypatch):
    """Items that share their opening: equal to brute force, and only pairs that may be best or over the threshold are tiled."""
    r = random.Random(11)
    opening = "which of the following is".split()
    items = [opening + [f"w{r.randrange(60)}" for _ in range(r.choice([2, 5, 9, 20]))] for _ in range(60)]
    docs = []
    for i in range(40):
        doc = [f"d{r.randrange(99)}" for _ in range(5)]
        for _ in range(r.randrange(4)):
            it = r.choice(items)
            doc += r.choice([it, it[:7], opening * 2, it[4:]]) + [f"d{r.randrange(99)}"]
        docs.append(doc)
    block = tiling.Block([(7 * i, np.array([hash_of(w) for w in it], np.uint64)) for i, it in enumerate(items)], 5)
    flat = np.array([hash_of(w) for d in docs for w in d], np.uint64)
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    for step in (1, 1 << 20):
        monkeypatch.setattr(tiling, "STEP_SEEDS", step)
        got = block.judge(flat, row, tiling.COVERAGE)
        early = block.judge(flat, row, tiling.COVERAGE, False)
        for d, doc in enumerate(docs):
            pairs = [(c / len(it), c, -j) for j, it in enumerate(items) if (c := brute_tiles(doc, it, 5))]
            best = max(pairs, default=None)
            assert (d in got) == (best is not None)
            if best:
                assert got[d][:3] == (best[0], best[1], -best[2])
                assert sorted(got[d][3]) == [-j for share, _, j in sorted(pairs, key=lambda x: -x[2]) if share >= tiling.COVERAGE]
            assert (early.get(d, (0,))[0] >= tiling.COVERAGE) == bool(best and best[0] >= tiling.COVERAGE)
    many = tiling.Block([(i, np.array([hash_of(w) for w in opening + [f"x{i}", *"abcdefgh"]], np.uint64)) for i in range(20_000)], 5)
    calls = []
    plain = tiling.greedy_tiles
    monkeypatch.setattr(tiling, "greedy_tiles", lambda *a: calls.append(1) or plain(*a))
    text = np.array([hash_of(w) for w in [f"t{i}" for i in range(1500)] + opening], np.uint64)
    assert many.judge(text, np.zeros(len(text), np.int64), tiling.COVERAGE) == {0: (5 / 14, 5, 0, [])}
    assert len(calls) == 1


def hash_of(word):
    return int.from_bytes(hashlib.sha1(word.encode()).digest()[:8], "little")


def test_tiling_corner_cases(spark):
    bench = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (None, "q q")], "item_id long, text string")
    got = tiling.decontaminate(rows(spark, ["a b c d e f", "d e f a b c", None], [1, 1, None]), bench).collect()
    assert sorted((r["doc_id"] or 0, r["contaminated"]) for r in got) == [(0, False), (1, False), (1, True)]
    assert [r["item_ids"] for r in got if r["contaminated"]] == [[1, 2]]
    assert tiling.decontaminate(rows(spark, ["a b"]), bench.limit(0)).first()["kept"]
    assert tiling.decontaminate(rows(spark, []), bench).count() == 0


# --- pipeline ----------------------------------------------------------------------------------------
def test_pipeline_equals_its_parts(spark):
    """Each stage against a brute-force version of it on its own input."""
    docs = sample(spark)
    q = corpus_pipeline.quality_stage(spark, docs, SF_SMALL)
    verdict = by_id(quality_rules.quality_report(docs))
    assert q.columns == docs.columns
    assert {r["doc_id"] for r in q.collect()} == {i for i, r in verdict.items() if r["kept"]}
    q = common.stored(q, "t")
    n = common.stored(corpus_pipeline.near_dedup_stage(spark, q, SF_SMALL), "t")
    texts = {r["doc_id"]: r["text"] for r in q.collect()}
    assert n.columns == docs.columns
    assert {r["doc_id"] for r in n.collect()} == {i for i, (_, c) in brute_components(texts).items() if c == i}
    s = common.stored(corpus_pipeline.substring_stage(spark, n, SF_SMALL), "t")
    own = [(r["doc_id"], r["text"]) for r in n.collect()]
    want = {i: (" ".join(k) if g else t) for (i, t), (_, g, k) in zip(own, brute_removed([t for _, t in own]))}
    assert s.columns == docs.columns and {r["doc_id"]: r["text"] for r in s.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in s.collect())
    c = common.stored(corpus_pipeline.decontamination_stage(spark, s, SF_SMALL), "t")
    items = [re.findall("[a-z0-9\u0080-\U0010ffff]+", r["text"].lower()) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    bad = set()
    for i, t in want.items():
        tok = re.findall("[a-z0-9\u0080-\U0010ffff]+", t.lower())
        grams = {tuple(tok[j:j + 5]) for j in range(len(tok) - 4)}
        for it in items:
            if any(tuple(it[j:j + 5]) in grams for j in range(len(it) - 4)) and brute_tiles(tok, it, 5) >= 0.6 * len(it):
                bad.add(i)
    assert c.columns == docs.columns and {r["doc_id"] for r in c.collect()} == set(want) - bad
    lib = library()
    last = by_id(corpus_pipeline.bpe_stage(spark, c, SF_SMALL))
    assert {i: r["n_tokens"] for i, r in last.items()} == {i: len(lib.encode_ordinary(want[i])) for i in set(want) - bad}
    assert by_id(corpus_pipeline.run(spark, SF_SMALL)) == last


def test_words_and_windows_helpers():
    t = pa.array(["a  bb\tc", None, "", "é x y", "\n"])
    data, off = common.text_buffers(t)
    w = common.Words(data, off)
    assert w.count.tolist() == [3, 0, 0, 2, 0]
    at, h = common.window_hashes(w.hashes(), w.row, 2)
    assert at.tolist() == [0, 1, 3] and len(set(h.tolist())) == 3
    assert common.ragged(np.array([5, 0, 2]), np.array([2, 0, 3])).tolist() == [5, 6, 2, 3, 4]


CLASHING = ["_q_kept", "_q_n_words", "_gone", "_cut", "_kept", "_row", "_rid", "_k", "_text", "_lang", "a.b", "x0", "x1", "item_id", "words"]


@pytest.mark.parametrize("ids", ["unique", "odd"])
def test_stages_leave_columns_of_any_name_alone(spark, ids):
    docs = sample(spark).where("length(text) < 3000")
    if ids == "odd":  # null and repeated ids
        docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 11 == 0, F.lit(None)).when(F.col("doc_id") % 13 == 0, F.lit(26)).otherwise(F.col("doc_id")))
    wide = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, out = stage(spark, docs, SF_SMALL), stage(spark, wide, SF_SMALL)
        assert out.columns == wide.columns, name
        rows = out.select(*[F.col(f"`{c}`") for c in out.columns]).collect()
        assert sorted(map(repr, (tuple(r)[:len(docs.columns)] for r in rows))) == sorted(map(repr, map(tuple, plain.collect()))), name
        for r in rows:
            assert all(r[c] == f"{c}:{'-' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING), name


def test_counting_grams_takes_memory_by_the_grams_that_occur(monkeypatch):
    import tracemalloc
    from collections import Counter

    from skyledger.llm import quality_rules as Q
    texts = [f"some words of text {i % 7}" for i in range(200)] + [None, ""]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[a:a + 50], pa.string())], ["text"]) for a in range(0, len(texts), 50)]
    want = Counter()
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        if len(data):
            want.update(Q.grams(data, np.array([0, len(data)]))[0].tolist())
    for merge_at in (1, 1 << 18):
        monkeypatch.setattr(Q, "MERGE_AT", merge_at)
        tracemalloc.start()
        got = [r for b in Q._count_batches(iter(batches)) for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(got) == len(want) and dict(got) == dict(want)
        assert peak < 32 << 20  # a slot for each of 2**24 possible grams took 128 MB a task
