"""Spelling variants, fill-in-the-middle and packing against brute force, on small tables with planted and odd rows."""

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from echoloom.llm import infill, packing, spelling

DOCS = "doc_id long, text string, lang string, n int, form string, word string, output string, `range` int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, parts=3):
    rows = [(i, t, "en", 1, "f", "w", "o", 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


ODD = [(None, None), (None, "nameless nameless nameless"), (1, None), (2, ""), (3, "  \n "), (4, "x"), (5, "é" * 70_000), (5, "é" * 70_000),
       (6, "doubled rows"), (6, "doubled rows"), (7, "<P> marker"), (8, "half <S marker <"), (9, "a b 　c d  e \t f\n\n g"),
       (10, "𝄞𝄞 clef 🎼 <|endoftext|> it's don't 12345 ÀÈ×÷ÿ"), (11, "tail spaces   "), (12, "   "), (13, "ab " * 30_000)]


# spelling variants

def counted(texts, typos):
    n = collections.Counter()
    for doc_id, text in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if typos and h % typos == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def spelling_brute(texts, typos):
    n = counted(texts, typos)
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        top = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def spelling_got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


@pytest.fixture(scope="module")
def misspelt():
    r = random.Random(11)
    base = ["".join(r.choices("abcé", k=r.randint(4, 8))) for _ in range(40)] + ["aaaaaa", "aaaaa", "ababab", "bababa", "z" * 9_000, "z" * 9_001]
    out = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = r.choice(base[:r.randint(1, len(base))])
            if len(w) < 20 and r.random() < 0.3:
                k = r.randrange(len(w))
                w = w[:k] + r.choice(["", w[k] + "a", "é", "b" + w[k]]) + w[k + 1:]
            words.append(w.upper() if r.random() < 0.1 and "é" not in w else w)
        out.append((i, "-1 ".join(words)))
    return out


@pytest.mark.parametrize("range_", [50_000, 40])
def test_spelling_variants(spark, misspelt, monkeypatch, range_):
    """With small ranges words of one beginning or end stand in several tasks."""
    monkeypatch.setattr(spelling, "RANGE", range_)
    texts = misspelt + ODD
    got = spelling_got(spelling.variants(frame(spark, texts), typos=7))
    want = spelling_brute(texts, 7)
    assert got == want
    assert sum(w[1] != "" for w in want) > 50 and any(w[2] not in (w[0], w[1]) for w in want)


def test_spelling_of_empty_tables(spark):
    assert spelling.variants(frame(spark, [], 1)).count() == 0
    assert spelling.variants(frame(spark, [(1, None), (2, "ab cd")])).count() == 0


@given(st.sets(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=30), st.sets(st.text("ab", min_size=1, max_size=6), max_size=4))
@settings(max_examples=60, deadline=None)
def test_trie_numbers_are_prefixes(words, cuts):
    """Two words share a node exactly where they share a beginning, also over ranges that know the cuts only."""
    cuts = sorted(cuts)
    nodes = {}
    for r in range(len(cuts) + 1):
        trie = spelling.Trie(cuts, (r + 1) << 40)
        for w in sorted(w for w in words if spelling.bisect_right(cuts, w) == r):
            for i, node in enumerate(trie.nodes(w)):
                assert nodes.setdefault(w[:i], node) == node
    assert len(set(nodes.values())) == len(nodes)


# fill in the middle

def infill_brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    lo, hi = sorted((a % (len(text) + 1), b % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return len(text), "plain", None, None, text
    p, m, s = text[:lo], text[lo:hi], text[hi:]
    if d % 100 < 20:
        return len(text), "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("chunk", [infill.CHUNK, 7])
def test_fill_in_middle(spark, monkeypatch, chunk):
    texts = ODD + [(i, f"text {i} " + "wörd <\n" * (i % 17)) for i in range(100, 300)]
    if chunk < 100:
        texts = [(i, t) for i, t in texts if len(t or "") < 1000]
        # workers import the module anew: the chunk is tested on the kernels themselves
        import pyarrow as pa
        monkeypatch.setattr(infill, "CHUNK", chunk)
        r = random.Random(3)
        lo = [r.randint(0, len(t or "")) for _, t in texts]
        hi = [r.randint(a, len(t or "")) for a, (_, t) in zip(lo, texts)]
        got = infill.roles(pa.array([t for _, t in texts]), pa.array(lo), pa.array(hi))
        for parts, a, b, (_, t) in zip(zip(*(g.to_pylist() for g in got)), lo, hi, texts):
            assert parts == ((t or "")[:a], (t or "")[a:b], (t or "")[b:])
        return
    df = frame(spark, texts)
    out = infill.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "lang", "word", "range", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = out.select("*", infill.restored().alias("back")).collect()
    got = collections.Counter((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows)
    assert got == collections.Counter((i, t, *infill_brute(i, t)) for i, t in texts)
    assert all(r.back == (r.text or "") and r.lang == "en" for r in rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(frame(spark, [], 1)).count() == 0


# packing

@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@functools.cache
def loaded(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def whole_ids(path, text):
    return loaded(path).encode(text or "", add_special_tokens=False).ids + [0]


def test_units_give_the_ids_of_whole_texts(tokenizer):
    import pyarrow as pa
    texts = [t for _, t in ODD] + [" a", "a ", "\n\n", "a\n b", "a\x1c b", "a\x85 b", "  x", "…  'll I'll 're\n\n\n  x", "１２ 34 五 六"]
    r = random.Random(5)
    texts += ["".join(r.choices(" \n\ta'sl1é 　 .𝄞\x1f\x7f", k=40)) for _ in range(300)]
    flat, offsets = packing.Encoder(tokenizer).encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert flat[a:b].tolist() == whole_ids(tokenizer, t), repr(t)


def check_packing(pieces, docs, length):
    """Every id is in one piece, sequences have no gaps and no padding; `docs` counts (doc_id, ids)."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0 and len(p.ids) == 4 * p.length
            at += p.length
        assert at <= length and at & (at - 1) == 0
    got = collections.Counter()
    for doc_id, its in by_doc.items():
        tiles = collections.Counter((p.start, bytes(p.ids)) for p in its)
        for ids, n in [(k[1], n) for k, n in docs.items() if k[0] == doc_id]:
            if n == 1 and sum(k[0] == doc_id for k in docs) == 1:
                joined = b"".join(b for _, b in sorted(tiles))
                assert joined == np.array(ids, "<u4").tobytes()
                assert [s for s, _ in sorted(tiles)] == list(np.cumsum([0] + [len(b) // 4 for _, b in sorted(tiles)][:-1]))
                assert {p.doc_tokens for p in its} == {len(ids)}
                got[(doc_id, ids)] += 1
            else:
                got[(doc_id, ids)] += n
        assert sum(p.length for p in its) == sum(len(k[1]) * n for k, n in docs.items() if k[0] == doc_id)
    assert got == docs


def test_packing(spark, tokenizer):
    r = random.Random(7)
    texts = ODD + [(i, " ".join(f"word{r.randrange(50)}" for _ in range(int(r.paretovariate(0.8) * 20)))) for i in range(100, 260)]
    docs = collections.Counter((i, tuple(whole_ids(tokenizer, t))) for i, t in texts)
    df = frame(spark, texts)
    for block in (packing.BLOCK, 5_000):
        pieces = packing.pack(df, tokenizer, block=block).collect()
        check_packing(pieces, docs, 1024)
        assert len({p.sequence_id for p in pieces}) >= sum(len(k[1]) * n for k, n in docs.items()) / 1024
    assert packing.pack(frame(spark, [], 1), tokenizer).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, tokenizer, length=1000)


def test_whole_sequences(spark, tokenizer):
    pieces = packing.pack(frame(spark, [(i, f"some words {i}") for i in range(300)], 2), tokenizer, length=64)
    rows = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    parts = collections.defaultdict(list)
    for p in pieces.collect():
        parts[p.sequence_id].append((p.offset, p.length, bytes(p.ids)))
    assert set(rows) == set(parts)
    for key, its in parts.items():
        assert bytes(rows[key].ids) == b"".join(b for *_, b in sorted(its))
        assert rows[key].n_tokens == sum(n for _, n, _ in its) and rows[key].ends == [o + n for o, n, _ in sorted(its)]


@given(st.lists(st.integers(0, 40), max_size=60))
@settings(max_examples=80, deadline=None)
def test_assignment_takes_the_cheapest_sequence_with_room(sizes):
    """Step by step against a plain search over all sequences."""
    capacities = packing.rooms(sum(sizes), 16)
    assert sum(capacities) == sum(sizes)
    got = packing.assigned(sizes, capacities).tolist()
    cost, room = [0.0] * len(capacities), list(capacities)
    order, steps = sorted(range(len(sizes)), key=lambda i: -sizes[i]), iter(got)
    for i in order:
        at, left = 0, sizes[i]
        while left:
            doc, start, size, b, offset = next(steps)
            assert (doc, start) == (i, at) and offset == capacities[b] - room[b]
            fits = [k for k in range(len(room)) if room[k] >= left]
            if fits:
                assert b in fits and size == left and cost[b] == min(cost[k] for k in fits)
            else:
                assert room[b] == max(room) == size
            cost[b] += packing.price(size)
            room[b] -= size
            at, left = at + size, left - size
    assert not any(room) and next(steps, None) is None


def test_costs_are_balanced():
    """Sequences of a block differ little in cost, and few documents are cut."""
    sizes = np.random.default_rng(1).integers(1, 400, 4000)
    pieces = packing.packed(sizes, 1024)
    cost = collections.Counter()
    for _, _, size, b, _ in pieces.tolist():
        cost[b] += packing.price(size)
    full = sorted(cost.values())[10:]
    assert max(full) < 1.1 * min(full) and len(pieces) < 1.4 * len(sizes)
