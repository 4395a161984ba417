"""HTML, chat, line dedup, search and toxicity against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import edge, edge_rows, nothing, small  # noqa: F401

from adtally.llm import chat, html, linedup, search, toxicity
from adtally.llm.queries import CONTROL_TEXT

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

# --- pages ---

PAGES = {
    "": "",
    "<html><body></body></html>": "",
    "just text &amp; more": "just text & more",
    "<p>one<p>two <b>bo</b>ld<br>three": "one two bold three",
    "<nav><a href=x>menu</a></nav><article><h1>T</h1><p>a&lt;b&nbsp; c</p><script>x='</p>'</script></article><footer>f</footer>": "T a<b c",
    "<body class=has-sidebar><div id=cookie-notice>We use cookies, a long sentence about them.</div><div class=wrap>"
    "<div class=post><h2>Title</h2><p>First para<b>graph</b> here.<p>Second one, with <a href=x>a link</a>.<ul><li>one<li>two</ul></div>"
    "<div class=sidebar><p>side text side text</div><div class=comments><p>nice post! a comment longer than the article itself, I think so, yes, it is</div>"
    "</div><div id=footer>foot</div>": "Title First paragraph here. Second one, with a link. one two",
    "<article><header><h1>Head</h1></header><p>text</p><form>f<input></form><aside>a</aside><div hidden>h</div></article><header>site</header>": "Head text",
    "<div><![broken[x]]>y</div>": None,
    "<div>" * 5000 + "deep": "deep",
    "</p></div>stray <b>unclosed": "stray unclosed",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    text = html.main_text(page)
    assert PAGES[page] is None or text == PAGES[page]


def test_pages(spark, small):
    rows = [(1, None, None, "x"), (None, "u", "<p>a</p>", "y"), (1, None, None, "x"), (2, "u", "<p>" + "long " * 50_000, "z")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html.extract(frame).collect())
    long = ("long " * 50_000).strip()
    assert got == [(0, "a", 1), (1, "", 0), (1, "", 0), (2, long, len(long))]
    assert html.extract(frame.limit(0)).collect() == []
    import html as library

    pages = spark.read.parquet(f"{small}/pages.parquet")
    for page, row in zip(pages.orderBy("page_id").collect(), html.extract(pages).orderBy("page_id").collect(), strict=True):
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        plain = library.unescape(re.sub(r"<[^>]+>", " ", re.sub("</?b>", "", inside)))
        assert row.text == " ".join(plain.split())


# --- conversations ---


def test_chat_edges(spark):
    rows = [
        (1, 0, "user", CONTROL_TEXT), (1, 1, "assistant", r"<\|im_end|> <\\| <<|"), (2, 0, "assistant", None), (2, 0, "assistant", None),
        (3, None, None, "x"), (3, 0, "sys%\n<|im_start|>", "y"), (None, 0, "user", "z" * 200_000), (4, 0, "system", ""), (4, 1, "user", "q"),
        (4, 1, "user", "a"), (4, 3, "assistant", "\n\n"),
    ]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    got = {r.conv_id: r for r in chat.digest(frame).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == sha("".join(f"{r}\n{t}\n" for *_, r, t in turns))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), sha(loss))
    assert [got[c].bad_turn for c in (1, 2, 3, 4, None)] == [None, 1, 1, 3, 2] and got[1].valid
    assert chat.digest(frame.limit(0)).collect() == []
    formatted = {r.conv_id: "".join(s.text for s in r.segments) for r in chat.format_conversations(frame).collect()}
    assert all(f.count("<|im_end|>") == len(groups[c]) == f.count("<|im_start|>") for c, f in formatted.items())
    pieces = defaultdict(int)
    for r in chat.turn_segments(frame).collect():
        pieces[r.conv_id] += len(r.text)
    assert pieces == {c: len(f) for c, f in formatted.items()}


# --- lines ---


def plain_dedup(rows, least=50):
    """Every repeated run by comparing windows of lines themselves."""
    seen: dict = {}
    gone = set()
    docs = sorted({(d is not None, d or 0, t) for d, t in rows if t})
    keyed = []
    for known, d, t in docs:
        lines = [(i, x) for i, x in enumerate(t.split("\n")) if WORD.search(x)]
        sizes = [len(WORD.findall(x)) for _, x in lines]
        for a in range(len(lines)):
            for b in range(a, min(len(lines), a + least)):
                if sum(sizes[a : b + 1]) >= least and (sum(sizes[a:b]) < least or sum(sizes[a + 1 : b + 1]) < least):
                    keyed.append((tuple(x for _, x in lines[a : b + 1]), (known, d, t), a, [i for i, _ in lines[a : b + 1]]))
    return keyed, seen, gone


def test_lines(spark, edge, edge_rows, nothing):
    rows = [(d, t) for d, t, *_ in edge_rows]
    keyed, first, gone = plain_dedup(rows)
    frame = linedup.dedup(edge).collect()
    versions = {(r.doc_id, r.text): r.v for r in edge.selectExpr("doc_id", "text", "xxhash64(text) v").collect()}
    place = lambda doc, a: (doc[0], doc[1], versions[(doc[1] if doc[0] else None, doc[2])], a)
    for content, doc, a, _ in keyed:
        first[content] = min(first.get(content, place(doc, a)), place(doc, a))
    for content, doc, a, lines in keyed:
        if place(doc, a) > first[content]:
            gone |= {(doc, i) for i in lines}

    def rest(d, t):
        if not t:
            return t
        doc = (d is not None, d or 0, t)
        return "\n".join(x for i, x in enumerate(t.split("\n")) if (doc, i) not in gone)

    want = sorted((r[6], rest(r[0], r[1]) or "") for r in edge_rows)
    assert sorted((r.size, r.text or "") for r in frame) == want
    assert any(r.n_deleted for r in frame) and set(edge.columns) | {"n_lines", "n_deleted"} == set(linedup.dedup(edge).columns)
    assert linedup.dedup(edge, counts=False).columns == edge.columns
    assert linedup.dedup(nothing).collect() == []


# --- search ---


def plain_search(docs, query, k):
    bags = [Counter(WORD.findall((t or "").translate(LOWER))) for _, t in docs]
    n, mean = len(docs), max(1.0, sum(sum(b.values()) for b in bags) / len(docs))
    df = Counter(w for b in bags for w in b)
    out = []
    for (d, _), bag in zip(docs, bags):
        shared = [w for w in set(WORD.findall((query or "").translate(LOWER))) if w in bag]
        if shared:
            size = sum(bag.values())
            score = sum(
                math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * 2.2 / (bag[w] + 1.2 * (0.25 + 0.75 * size / mean))
                for w in sorted(shared)
            )
            out.append((-round(score, 9), d is None, d))
    return sorted(out, key=lambda x: (x[0], x[1], x[2] or 0))[:k]


@pytest.mark.parametrize("shard_words", [200, 3_000_000])
def test_search(spark, edge, edge_rows, nothing, monkeypatch, shard_words):
    monkeypatch.setattr(search, "SHARD_WORDS", shard_words)
    docs = [(d, t) for d, t, *_ in edge_rows]
    asked = [(1, docs[0][1]), (2, "a B zz"), (3, None), (4, "spam"), (5, docs[13][1]), (2, "c"), (None, "spam")]
    queries = spark.createDataFrame(asked, "query_id long, text string")
    got = defaultdict(list)
    for r in search.search(edge, queries, 4).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.doc_id, r.score))
    for q, text in ((1, asked[0][1]), (2, "a B zz c"), (3, ""), (4, "spam"), (5, asked[4][1])):
        want = [(i, d, -s) for i, (s, _, d) in enumerate(plain_search(docs, text, 4), 1)]
        assert [(i, d) for i, d, _ in got[q]] == [(i, d) for i, d, _ in want]
        assert np.allclose([s for *_, s in got[q]], [s for *_, s in want], atol=2e-9)
    assert search.search(nothing, queries).collect() == [] and search.search(edge, queries.limit(0)).collect() == []


@pytest.mark.parametrize("batch, lookup", [(1, 0), (8, 0), (32, 0), (32, 40)])
def test_pruning_is_exact(monkeypatch, batch, lookup):
    monkeypatch.setattr(search, "BATCH", batch)
    monkeypatch.setattr(search, "LOOKUP", lookup)
    rng = np.random.default_rng(4)
    lengths = rng.integers(5, 60, 3000)
    hashes = [np.sort(rng.zipf(1.3, n).astype(np.uint64)) for n in lengths]
    row = search._shard(list(range(3000)), [np.concatenate(hashes)], [lengths]).to_pylist()[0]
    shard = search.Shard(row, float(lengths.mean()))
    idf = np.log1p((3000 - np.diff(shard.begins) + 0.5) / (np.diff(shard.begins) + 0.5))
    for _ in range(40):
        at = np.unique(rng.integers(0, len(shard.terms), rng.integers(1, 8)))
        score = np.zeros(3000)
        for t in at:
            span = slice(shard.begins[t], shard.begins[t + 1])
            score[shard.docs[span]] += shard.weights[span] * idf[t]
        (docs, scores), = shard.top([(at, idf[at])], 5)
        want = np.lexsort((np.arange(3000), -np.round(score, 9)))[:5]
        want = want[score[want] > 0]
        got = docs[np.lexsort((docs, -np.round(scores, 9)))]
        assert got.tolist() == want.tolist()


# --- toxicity ---


def test_toxicity_edges(spark, edge, edge_rows, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    blank = toxicity.score(edge, toxicity.learn(edge, none)).collect()
    assert len(blank) == len(edge_rows) and {(r.score, r.predicted) for r in blank} == {(0.0, 0)}
    marks = spark.createDataFrame([(d, int(d == 1)) for d in range(1, 20)] + [(1, 0), (2, None)], "doc_id long, toxic int")
    got = toxicity.score(edge, toxicity.learn(edge, marks)).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
    assert toxicity.score(nothing, toxicity.learn(nothing, marks)).collect() == []


def test_toxicity_learns(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abdeghiklmnoprstu") for _ in range(rng.randint(3, 8))) for _ in range(4000)]
    rows, marks = [], []
    for i in range(4000):
        text = rng.choices(vocabulary, k=rng.randint(20, 120))
        bad = rng.random() < 0.1
        for _ in range(rng.randint(2, 5) * bad):
            text.insert(rng.randrange(len(text)), rng.choice(["Vilewort!", "foulish", "grumble" + rng.choice(["d", "st", "r"])]))
        rows.append((i, " ".join(text)))
        if rng.random() < 0.5:
            marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    held = [(bad, got[i].predicted) for i, bad in marks if got[i].held_out]
    toxic = [p for bad, p in held if bad]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(p for bad, p in held if not bad) <= 0.01 * len(held)
    again = toxicity.score(docs, toxicity.learn(docs.repartition(5), labels)).collect()
    assert all(abs(r.score - got[r.doc_id].score) < 1e-6 for r in again)


def test_risk_correction():
    positive, unlabelled = np.ones((4, 1), dtype=np.float32), np.ones((4, 1), dtype=np.float32)
    w = np.array([5.0])
    pushed, _ = toxicity.nnpu_gradient(w, 0.0, positive, unlabelled, 0.5)  # U's risk is not below P's share of it
    turned, _ = toxicity.nnpu_gradient(w, 0.0, positive, np.zeros((4, 1), dtype=np.float32), 0.5)
    assert pushed[0] == pytest.approx(-0.5 + 1 / (1 + math.exp(-5)), abs=1e-6)
    assert turned[0] > 0
