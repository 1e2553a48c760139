"""Cross-tokenizer alignment, hard negatives and substring dedup against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from packetlens.llm import alignment, hard_negatives, substring_dedup, words
from packetlens.llm.common import stored
from packetlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def rnd(seed, n):
    r = random.Random(seed)
    return " ".join(r.choices(WORDS, k=n))


# --- 11 alignment ------------------------------------------------------------------------

A_FILE, B_FILE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\nb", "a \n b", "a\n\n  b", "\t x", "▁", "a▁b", "a ▁ b",
    "<|endoftext|> a", "</s> <s> <unk> <0x41>", "é ́a İstanbul", "日本語のテキスト 日本", "\U0001F600\U0001F600 x", "\0 b",
    "a\xa0b \xa0 c", "A\x1c b", "x" * 3000, "=" * 500, "1,000.50 and 3.. ,4", "don't 'tis  we'll", "a\rb;\r c", "　全角　",
]


def byte_table():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@pytest.fixture(scope="module")
def plain():
    """Token ids and bytes of whole texts by the libraries."""
    a, b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    table = byte_table()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return ([(i, bytes(table[c] for c in a.id_to_token(i))) for i in ids_a], [(i, piece(i)) for i in ids_b])

    return tokens


def aligned_by_bytes(tokens, text):
    """Groups as text and links, from the owner of every byte."""
    if not text:
        return None
    a, b = tokens(text)
    raw = (" " + text).encode()
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return None
    own_a, own_b = ([i for i, (_, t) in enumerate(side) for _ in t] for side in (a, b))
    ends = [set(itertools.accumulate(len(t) for _, t in side)) for side in (a, b)]
    groups, start = [], 0
    for end in sorted(ends[0] & ends[1]):
        groups.append("|".join(
            ",".join(str(side[i][0]) for i in sorted(set(own[start:end])))
            for side, own in ((a, own_a), (b, own_b))))
        start = end
    links = sorted(set(zip(own_a, own_b, strict=True)))
    return len(a), len(b), groups, [(a[i][0], b[j][0]) for i, j in links]


def expected(tokens, texts):
    found = [aligned_by_bytes(tokens, t) for t in texts]
    counts = collections.Counter(link for f in found if f for link in f[3])
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (0, 0, 0, 0, "", 0, 0) if f is None else
        (f[0], f[1], len(f[2]), len(f[3]), ";".join(f[2]), sum(counts[x] == most[x[1]] for x in f[3]),
         sum(counts[x] for x in f[3]))
        for f in found
    ]


def aligned_rows(docs, limit=alignment.FREQUENT):
    rows, name = alignment.align(docs, A_FILE, B_FILE)
    rows = stored(rows, "aligned")
    counts = stored(alignment.link_counts(rows, name), "counts")
    rows, linked = alignment.with_counts(rows, name, counts, limit)
    return rows, name, linked


@pytest.mark.parametrize("limit", [alignment.FREQUENT, 40, 0])
def test_alignment_equals_owners_of_bytes(spark, frame, plain, limit):
    r = random.Random(5)
    signs = ["a", "b", "'s", " ", " ", "\n", "\xa0", "1", "é", "́", ".", "▁", "日本", "the", " of", "\x1c", "\r"]
    texts = ODD + ["".join(r.choices(signs, k=r.randint(1, 40))) for _ in range(150)] + [rnd(1, 300)] * 2
    rows, name, linked = aligned_rows(frame(list(enumerate(texts))).repartition(3), limit)
    got = {x.doc_id: x for x in rows.select("doc_id", f"{name}.*", f"{linked}.n_best", f"{linked}.count_sum").collect()}
    for i, want in enumerate(expected(plain, texts)):
        x = got[i]
        assert (x.n_a, x.n_b, x.n_groups, x.n_links, x.groups, x.n_best, x.count_sum) == want, texts[i]


def test_alignment_query(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = expected(plain, [d.text for d in docs])
    got = {r.doc_id: r for r in QUERIES["op11_alignment"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d, w in zip(docs, want, strict=True):
        r = got[d.doc_id]
        digest = hashlib.sha256(w[4].encode()).hexdigest() if w[4] else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) == (*w[:4], digest, *w[5:])


def test_alignment_memory_may_be_full(monkeypatch, plain):
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    own = alignment.Aligner(A_FILE, B_FILE)
    texts = ["one two three four five", "six seven eight", "one two nine ten"]
    for _ in range(2):
        got = own.texts(texts)["groups"]
        assert got == [";".join(aligned_by_bytes(plain, text)[2]) for text in texts]


def test_alignment_of_no_rows_and_clashing_names(spark, frame):
    empty, _, _ = aligned_rows(frame([]))
    assert empty.collect() == []
    docs = frame([(1, "a b"), (1, "a b"), (None, None)]).withColumns(
        {c: F.lit(c) for c in ("aligned", "linked", "row", "pairs", "rest")})
    for limit in (alignment.FREQUENT, 0):
        rows, name, linked = aligned_rows(docs, limit)
        got = rows.select("doc_id", "text", "pairs", "row", "rest", f"{name}.n_a", f"{linked}.count_sum").collect()
        assert sorted(got, key=str) == sorted(
            [(1, "a b", "pairs", "row", "rest", 2, 4)] * 2 + [(None, None, "pairs", "row", "rest", 0, 0)], key=str)


# --- 12 hard negatives --------------------------------------------------------------------


def plain_negatives(rows, every):
    """rows: (vec_id, label, vector); anchors are those whose vec_id ``every`` divides."""
    use = {(i, lab, tuple(np.floor(256.0 * np.array(v, "f8")).astype(int).tolist()))
           for i, lab, v in rows
           if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v)}
    width = max((len(v) for _, _, v in use), default=0)
    use = [(i, lab, v + (0,) * (width - len(v))) for i, lab, v in use]
    out = []
    for a, lab, v in use:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, other, w in use)
        positives = [(i, -s) for s, i, other in scored if other == lab and i != a][:5]
        for p, ps in positives:
            fits = [(i, -s) for s, i, other in scored if other != lab and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(a, p, k + 1, n, ps, ns) for k, (n, ns) in enumerate(fits)]
    return sorted(out)


EMBEDDINGS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])


def mined(spark, rows, every, **sizes):
    df = spark.createDataFrame(rows, EMBEDDINGS).withColumn("rank", F.lit("extra"))
    found = hard_negatives.mine(df.repartition(3), F.col("vec_id") % every == 0, **sizes)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                  for r in found.collect())


def vectors(n, dims, seed, copies=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dims))
    rows = []
    for i in range(n):
        v = centres[r.integers(4)] + 0.6 * r.normal(size=dims)
        rows.append((i, int(r.integers(3)), [float(np.float32(x)) for x in v]))
    return rows + [(n + i, i % 3, rows[0][2]) for i in range(copies)]


@pytest.mark.parametrize("dims,copies,block,group", [(2, 40, 16, 4), (6, 0, 32, 7), (1, 200, 50, 1000)])
def test_negatives_equal_brute_force(spark, frame, dims, copies, block, group):
    rows = vectors(300, dims, dims, copies)
    got = mined(spark, rows, 5, block=block, group=group)
    assert got and got == plain_negatives(rows, 5)


def test_negatives_query(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                 for r in QUERIES["op12_hard_negatives"](spark, SF).collect())
    assert got and got == plain_negatives(rows, 50)


def test_negatives_of_odd_rows(spark, frame):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 3, 9) + [
        (None, 1, [1.0, 1.0, 1.0]), (100, None, [1.0, 1.0, 1.0]), (101, 1, None), (102, 1, [1.0, None, 1.0]),
        (103, 1, [nan, 1.0, 1.0]), (104, 1, [1.0, inf, 1.0]), (105, 2, []), (110, 0, [2.0, 2.0]),
        (5, 1, [1.0, 0.5, 0.25]), (115, 1, [0.0, 0.0, 0.0]),
    ]
    assert mined(spark, rows + rows, 5, block=8, group=3) == plain_negatives(rows, 5)
    assert mined(spark, [], 5) == []
    assert mined(spark, [(0, None, None), (5, 1, [])], 5) == []
    # One label only, one row only, and no anchor.
    assert mined(spark, [(i, 1, [1.0]) for i in range(10)], 5) == []
    assert mined(spark, [(0, 1, [1.0])], 5) == []
    assert mined(spark, vectors(20, 2, 1), 1000) == plain_negatives(vectors(20, 2, 1), 1000)


def test_large_components_stay_exact(spark, frame):
    rows = [(i, i % 2, [float(np.float32(1e6 + 100 * i)), float(np.float32(-3e5 + i))]) for i in range(40)]
    assert mined(spark, rows, 4, block=8) == plain_negatives(rows, 4)


def test_hilbert_keys_visit_every_cell_by_unit_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 1)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hard_negatives.hilbert_keys(grid, bits)
        assert len(set(keys)) == len(grid)
        path = grid[np.argsort(np.array([int.from_bytes(k) for k in keys]))]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_leave_blocks_out():
    r = np.random.default_rng(0)
    a, v = r.integers(-99, 99, (20, 4)), r.integers(0, 50, (30, 4))
    low, high = hard_negatives.bounds(a, v.min(0)[None], v.max(0)[None])
    scores = a @ v.T
    assert (low[:, 0] <= scores.min(1)).all() and (high[:, 0] >= scores.max(1)).all()
    assert (high[:, 0] < 50 * 4 * 99).all()


# --- 13 substring dedup -------------------------------------------------------------------


def plain_dedup(texts):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    size = substring_dedup.WINDOW
    times = collections.Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if times[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def deduped(docs):
    rows, name = substring_dedup.remove_repeats(docs)
    return sorted(tuple(r) for r in rows.select("n", f"{name}.n_words", f"{name}.n_removed", f"{name}.kept").collect())


def check_dedup(frame, texts, parts=3):
    docs = frame([(i % 7, t) for i, t in enumerate(texts)])
    numbered = docs.sparkSession.createDataFrame(
        [(i, i % 7, t) for i, t in enumerate(texts)], "n int, doc_id bigint, text string")
    got = deduped(numbered.repartition(parts))
    assert got == [(i, *w) for i, w in enumerate(plain_dedup(texts))]
    return got


def test_repeats_equal_brute_force(frame):
    passage, line = rnd(100, 60), rnd(101, 35)
    texts = [
        None, "", " \n\t", "one", rnd(1, 34), rnd(2, 35), rnd(3, 200), passage, f"{rnd(4, 50)}\n{passage}\t{rnd(5, 40)}",
        f"{passage}  {rnd(6, 3)}", passage.upper(), line, f"x {line} y", f"{line} {line}", " ".join(["same"] * 300),
        " ".join(["same"] * 40), " ".join(["a", "b"] * 100), rnd(7, 3000), rnd(7, 3000), "é\xa0ü " * 50, "é\xa0ü " * 36,
        rnd(2, 35), " ".join(rnd(3, 200).split()[50:90]), "z" * 5000 + " " + rnd(8, 100), "\x1c".join(rnd(9, 60).split()),
    ]
    got = check_dedup(frame, texts)
    assert sum(r[2] for r in got) > 0
    check_dedup(frame, [f"{a} {b}" for a in texts if a for b in texts[7:10]], parts=1)


def test_heavy_grams_and_small_buckets(frame, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HEAVY_LEAST", 3)
    monkeypatch.setattr(substring_dedup, "BUCKETS", 2)
    monkeypatch.setattr(substring_dedup, "TOGETHER", 3000)
    passage = rnd(200, 80)
    texts = [f"{rnd(i, i % 50)} {passage} {rnd(500 + i, i % 41)}" for i in range(60)] + [passage] * 20 + ["w " * 90] * 3
    check_dedup(frame, texts)


def test_repeats_of_no_rows_and_clashing_names(spark, frame):
    rows, name = substring_dedup.remove_repeats(frame([]))
    assert rows.collect() == []
    text = rnd(1, 50)
    docs = frame([(1, text), (1, text), (None, text), (None, None)]).withColumns(
        {c: F.lit(c) for c in ("row", "id", "cover", "repeats", "kept", "hits")})
    rows, name = substring_dedup.remove_repeats(docs)
    assert rows.columns == [*docs.columns, name]
    got = rows.select("doc_id", "row", "id", "cover", "repeats", f"{name}.n_removed", f"{name}.kept").collect()
    assert sorted(got, key=str) == sorted(
        [(d, "row", "id", "cover", "repeats", n, "") for d, n in ((1, 50), (1, 50), (None, 50), (None, 0))], key=str)


def test_equal_hashes_of_different_windows_are_told_apart(monkeypatch):
    strings = [rnd(1, 60).encode(), rnd(2, 60).encode(), rnd(1, 60).encode()]
    monkeypatch.setattr(substring_dedup, "rolled", lambda h, n: np.zeros(max(0, len(h) - n + 1), "u8"))
    owner, _, again = substring_dedup.repeated_windows(strings, np.zeros(3, bool))
    assert set(owner[again].tolist()) == {0, 2} and (~again).sum() == 26


def test_rolled_hashes_depend_on_their_words_alone():
    w = np.random.default_rng(1).integers(0, 1 << 62, 50).astype("u8")
    again = np.concatenate([w[20:], w[5:30]])
    for n in (1, 2, 3, 7, 25):
        one, two = words.rolled(w, n), words.rolled(again, n)
        assert (two[30:30 + 26 - n] == one[5:5 + 26 - n]).all() and len(set(one.tolist())) == len(one)
    assert len(words.rolled(w, 51)) == 0


def test_repeats_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op13_substring_dedup"](spark, SF).collect()}
    for d, (n, gone, kept) in zip(docs, plain_dedup([d.text for d in docs]), strict=True):
        r = got[d.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
