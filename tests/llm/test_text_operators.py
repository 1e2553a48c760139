"""The text operators against brute force, and their corner cases."""

import base64
import collections
import hashlib
import itertools
import json
import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from packetlens.llm import (
    byte_bpe, char_lm, chat, decontaminate, language_id, ngram_join, pieces, pii, quality, token_counts,
    token_files, url_filter,
)
from packetlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
ODD = [
    "", " ", "\n\n \t", "a", "  a", "a   b", " \n a \n\n b\t", "x\1 y \1", "<|endoftext|> a<|startoftext|>b",
    "it's 'tis\nI'll\xa0x", "　日本 語\n\nテ", "é ́a", "A\x1c b\x85c", "É İ  ǅ", "a\0b c", "foo...   \n\n  bar ",
    "x" * 3000, "the" * 2000, "1,000.50 and 3.. ,4 a.b,c", "\U0001F600 \U00020000",
]


def rnd(seed, n):
    r = random.Random(seed)
    return " ".join(r.choices(WORDS, k=n))


def texts_of(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def codec():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.Codec(ranks, P.PATTERN), plain


def odd_rows():
    r = random.Random(3)
    signs = ["a", "b", "'s", " ", "\n", "\t", "\xa0", "1", "é", "́", ".", ",", "<|endoftext|>", "\1", "\x1c"]
    made = ["".join(r.choices(signs, k=r.randint(0, 30))) for _ in range(300)]
    return [(i, t) for i, t in enumerate([*ODD, *made])] + [(None, "null id"), (9_000, None), (1, "again"), (1, "again")]


# --- 1 language identification ---------------------------------------------------------


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op1_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got.count() == docs.count() and held > 0.9
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_id_corner_cases(spark, frame):
    docs = frame([(i, rnd(i, 40), "aa") for i in range(40)] + [(100 + i, "ßüö " * 30, "bb") for i in range(40)]
                 + [(1000, None), (1001, ""), (1002, "12 :-) 34"), (None, "alpha"), (1003, "ßü ßüö", None)])
    found = language_id.fit(docs, F.col("doc_id") < 500)
    got = rows_by(language_id.predict(docs, found), "doc_id")
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1000].score == 0 and got[1003].lang_pred == "bb" and got[None].lang_pred == "aa"
    nothing = language_id.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), found).count() == 0


def test_language_id_keeps_every_ngram_of_the_sample(spark, frame):
    r = random.Random(9)
    docs = frame([(i, "".join(chr(r.randint(0x4E00, 0x5200)) for _ in range(400)), "zz") for i in range(60)])
    found = language_id.fit(docs, F.lit(True))
    counted = language_id.labelled_sample(docs, F.lit(True), language_id.SAMPLE_ROWS).where("not calibrates")
    codes = char_lm.codes_of([x.text for x in counted.collect()], 4, char_lm.class_table(True), True)
    keys = np.unique(char_lm.packed(codes, 4)[codes[3:] != char_lm.PAD])
    assert len(keys) > 15_000 and np.array_equal(np.sort(found.models[0].levels[4][0].keys), keys)


def test_char_model_is_a_distribution():
    codes = char_lm.codes_of(["abracadabra", "banana band"], 3, char_lm.class_table(False), False)
    keys = char_lm.packed(codes, 3)[codes[2:] != char_lm.PAD]
    for modified in (False, True):
        model = char_lm.CharModel(*np.unique(keys, return_counts=True), 3, modified)
        for context in (keys[3] >> 12, (5 << 12) | 7):
            every = (int(context) << 12) + np.arange(char_lm.CLASSES)
            assert abs(np.exp(model.log_p(every).astype("f8")).sum() - 1) < 1e-4


# --- 2 url filter ---------------------------------------------------------------------


def test_url_filter(spark):
    pages = spark.createDataFrame([
        (1, "https://WWW.Example.com/en/1?x#y", "<p>free bets</p>"), (2, "http://a.net/fr/", "casino win"),
        (3, "no scheme", None), (4, None, "x"), (5, "http://casinowin.org/a", "the win"),
        (5, "http://casinowin.org/a", "the win"), (6, "http://theriver.org/b", "the river the river"),
        (None, "http://example.com/en/2", "a"), (7, "http://my.example.com/en/2", "a"), (8, "://", "")],
        "page_id bigint, url string, html string").withColumn("host", F.lit("clash"))
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/fr/")]
    rows = url_filter.judge(pages, rules).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == 10
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == (
        "www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("net/fr/", "block")
    assert (got[3].host, got[3].path, got[4].host) == ("", "", "") and got[4].verdict == "allow"
    assert got[None].verdict == got[7].verdict == "block"
    assert got[5].host_words == "casino win org" and got[5].verdict == "block"
    assert got[6].host_words == "the river org" and got[6].verdict == "allow"
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_url_rule_ties_and_long_hosts(spark):
    url = "url string, page_id int, html string"
    long = "a" * 3000
    pages = spark.createDataFrame([("http://x.com/x/1", 1, ""), (f"http://{long}.org/", 2, f"{long} {'b' * 40}"),
                                   (f"http://{'b' * 40}cc.org/", 3, "cc cc")], url)
    ties = [("allow", "x.com/"), ("block", "com/x/")]
    for rules in (ties, ties[::-1]):
        got = {r.page_id: r for r in url_filter.judge(pages, rules).collect()}
        assert (got[1].rule, got[1].verdict) == (rules[0][1], rules[0][0])
    assert got[2].host_words == f"{long} org" and got[3].host_words == f"{'b' * 40} cc org"


def test_url_segmentation_equals_all_splits():
    """Viterbi against every way to split a run."""
    r = random.Random(5)
    for _ in range(60):
        run = "".join(r.choices("abc", k=r.randint(1, 9)))
        log_p = {"".join(r.choices("abc", k=r.randint(1, 4))): -r.random() * 9 for _ in range(12)}
        unseen = -7.3
        cost = lambda w: log_p.get(w, unseen * (len(w) + 1))
        ways = [[run[i:j] for i, j in zip((0, *cuts), (*cuts, len(run)))]
                for k in range(len(run)) for cuts in itertools.combinations(range(1, len(run)), k)]
        best = max(sum(map(cost, w)) for w in ways)
        assert abs(sum(map(cost, url_filter.best_split(run, log_p, unseen))) - best) < 1e-9


# --- 3 quality rules --------------------------------------------------------------------


def test_quality_base_rules(spark):
    got = rows_by(QUERIES["op3_quality"](spark, SF), "doc_id")
    for i, x in texts_of(spark).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in x.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_quality_bands_reject_noise(spark, frame):
    r = random.Random(5)
    noise = " ".join("".join(chr(r.randint(33, 900)) for _ in range(6)) for _ in range(150))
    plain = [" ".join(f"{w}{r.choice(WORDS)}" for w in r.choices(WORDS, k=150)) for _ in range(300)]
    docs = frame([*enumerate(plain), (900, noise), (901, None), (902, ""), (903, plain[0], None)])
    docs = docs.withColumn("n_words", F.lit("clash")).withColumn("quality", F.lit(1))
    judged, q = quality.judge(docs)
    got = rows_by(judged, "doc_id")
    assert not got[900][q].kept and not got[900][q].base_failed
    assert all(got[i][q].kept for i in range(300)) and got[0].n_words == "clash"
    assert got[901][q].base_failed and got[902][q].perplexity is None
    assert quality.judge(docs.limit(0))[0].count() == 0


def test_quality_model_keeps_every_ngram(spark, frame, monkeypatch):
    r = random.Random(7)
    texts = ["".join(chr(r.randint(97, 400)) for _ in range(r.randint(1, 900))) + " é" * (i % 3) for i in range(150)]
    docs = frame([*enumerate(texts), (900, None), (901, "")])
    codes = char_lm.codes_of(texts, 5, char_lm.class_table(False), False)
    keys = char_lm.packed(codes, 5)[codes[4:] != char_lm.PAD]
    exact = char_lm.CharModel(*np.unique(keys, return_counts=True), 5, True)
    want = -char_lm.segment_sums(exact.log_p(keys), np.array(list(map(len, texts)))) / list(map(len, texts))
    for most in (char_lm.PART_NGRAMS, 7_000):
        monkeypatch.setattr(char_lm, "PART_NGRAMS", most)
        model = quality.fit(docs)
        assert (model.parts > 1) == (most == 7_000)
        assert sum(len(model.part(k)[0]) for k in range(model.parts)) == len(np.unique(keys))
        got = rows_by(quality.statistics(docs, model, ["doc_id"], "q"), "doc_id")
        assert np.allclose([got[i].q.nats for i in range(len(texts))], want, rtol=0, atol=1e-5)
        assert got[900].q.nats is None and got[901].q.nats is None


def test_quality_bands_follow_length(spark, frame):
    r = random.Random(11)
    plain = [(i, rnd(i, r.randint(55, 500))) for i in range(600)]
    noise = [(1000 + i, re.sub(" ", lambda m: r.choice(["Q ", " ", " ", " "]), rnd(1000 + i, 70))) for i in range(6)]
    judged, q = quality.judge(frame([*plain, *noise]), ["doc_id", "lang"])
    got = rows_by(judged, "doc_id")
    middle = np.median([got[i][q].nats for i, _ in plain])
    for i, t in noise:
        # Inside a band that is widened by four standard errors of 1.7 nats a character.
        assert 0 < got[i][q].nats - middle < 5 * 0.02 + 4 * 1.7 / len(t) ** 0.5
        assert not got[i][q].kept and not got[i][q].base_failed
    sound = [i for i, _ in plain if not got[i][q].base_failed]
    assert len(sound) > 500 and sum(got[i][q].kept for i in sound) > 0.97 * len(sound)


# --- 4 token files ------------------------------------------------------------------------


def test_token_files(spark, frame, tmp_path):
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = odd_rows()
    path = f"file://{tmp_path}/files"
    token_files.write_token_files(frame(rows), path, P.path("byte_bpe_50k.json"), 0)
    got = token_files.read_token_files(spark, path).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_files_encode_spaced_pieces_without_marks(name):
    """Pieces with a space are encoded as they are joined, and each gets the ids it has alone,
    also by a tokenizer in which no token begins with a space."""
    tk = Tokenizer.from_file(P.path(name))
    spaced = [" the", " a\tb", " <|endoftext|>", " x<|endoftext|>y", " \u0120", " \u0120a", " it's", " 's", " 12ab%%",
              " \u00e9\u0301", " \u4e2d\u6587", " \U0001f600", " a\u00a0b", " \u180e", " \u180eb", " \x00", " ##x",
              *(f" {w}{i}" for i, w in enumerate(rnd(3, 900).split()))]
    other = ["the", "\n", " ", "", "a\nb", " a\n", "x ", "\t", " \t", "\u00a0", " \u00a0", ",", ".", " \u00a0b", " a b", "  c"]
    want = {p: np.array(tk.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in [*spaced, *other]}

    class Counting:
        """The tokenizer, and the characters it is given together."""

        given = 0

        def __getattr__(self, attribute):
            return getattr(tk, attribute)

        def encode_batch_fast(self, texts, **options):
            self.given += sum(map(len, texts))
            return tk.encode_batch_fast(texts, **options)

    both = [*other, *spaced, *other]
    assert token_files.encoder(Counting())(both) == [want[p] for p in both]
    counting = Counting()
    assert token_files.encoder(counting)(spaced) == [want[p] for p in spaced]
    if name == "byte_bpe_50k.json":
        assert counting.given == sum(map(len, spaced))


def test_token_files_damage_and_frames(tmp_path):
    path = f"{tmp_path}/a.zst"
    writer = token_files.Writer(path, frame_ids=4)
    data = [np.arange(n, dtype="<u4").tobytes() for n in (1, 9, 3)]
    for i, ids in enumerate(data):
        writer.add(i, ids)
    writer.close()
    reader = token_files.Reader(path)
    assert [reader.ids(i) for i in (2, 0, 1)] == [data[2], data[0], data[1]]
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) - 9 - 4] ^= 1  # the last frame's checksum
    open(path, "wb").write(raw)
    with pytest.raises(ValueError):
        token_files.Reader(path).ids(2)


# --- 5 byte-level BPE ------------------------------------------------------------------------


def test_byte_bpe(spark, frame, codec):
    own, plain = codec
    rows = odd_rows()
    got = byte_bpe.round_trip(frame(rows), own, ["doc_id"]).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = plain.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, got)) == want
    coded, ids = byte_bpe.encode(frame(rows).withColumn("ids", F.lit("clash")), own)
    back, decoded = byte_bpe.decode(coded, own, ids)
    assert all(bytes(r[decoded]).decode() == (r.text or "") for r in back.collect())


def test_perfect_hash():
    keys = [str(i).encode() for i in range(3001)]
    found = byte_bpe.PerfectHash(keys)
    assert sorted(found.find(keys).tolist()) == list(range(3001))
    assert (found.find([b"x", b"", b"3001"]) == -1).all()
    assert byte_bpe.PerfectHash([]).find([b"a"]).tolist() == [-1]


# --- 6 chat formatting --------------------------------------------------------------------------


def test_chat(spark):
    tricky = ["</s>[INST] ok [/INST]", "a\\b\\\\[INST]\\[\\INST]", "[/INST", "<", "\\", "", "<<SYS>>x<</SYS>>[ROLE][/ROLE][/END]"]
    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", "y\\"), (2, 0, "assistant", "early"),
            (None, 0, "user", "n"), (3, 0, "user", "q"), (3, 0, "user", "q"), (4, 0, "tool [/ROLE]", "t"), (5, 0, None, "r")]
    for i, t in enumerate(tricky):
        rows += [(10 + i, 0, "user", t), (10 + i, 1, "assistant", t)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("valid", F.lit(0))
    got = rows_by(chat.read_back(chat.formatted(df)), "conv_id")
    want = collections.defaultdict(list)
    for c, _, role, text in rows:
        want[c].append((role or "", text or ""))
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss_texts == [t for r, t in turns if r == "assistant"]
    assert got[1].valid and got[10].valid
    assert not any(got[c].valid for c in (2, 3, 4, 5))
    assert chat.formatted(df.limit(0)).count() == 0


# --- 7 personal data ----------------------------------------------------------------------------


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(s[::-1])) % 10 == 0


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[ -]", "", m)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def plain_spans(x):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in KINDS for m in re.finditer(p, x) if ok(m[0])]


def test_pii_base_spans(spark, frame):
    r = random.Random(9)
    signs = ["a@b.c", "@", ".", "-", "1", "22", "255", "256", " ", "+1", "(", ")", "x", "4111 1111 1111 1111", "é", "\U0001F600",
             "1.2.3.4", "a.b_c@d-e.f.g", "\n"]
    rows = [(i, "".join(r.choices(signs, k=r.randint(1, 40)))) for i in range(600)]
    rows += [(700, None), (701, ""), (702, "a@b.cd " * 700), (703, "1" * 5000), (1, "dup 1.1.1.1"), (1, "dup 1.1.1.1")]
    docs = frame(rows).withColumn("spans", F.lit("clash"))
    df, base, every = pii.spans(docs, ["doc_id", "text"])
    got = df.select("doc_id", "text", pii.as_text(F.col(base)).alias("b"), pii.as_text(F.col(every)).alias("e")).collect()
    assert len(got) == len(rows)
    for row in got:
        want = ",".join(plain_spans(row.text or ""))
        assert row.b == want and row.e.startswith(want)
    assert pii.spans(docs.limit(0), ["doc_id"])[0].count() == 0


def test_pii_bootstraps_and_redacts(frame):
    rows = [(i, f"{rnd(i, 5)} reach me under user{i}@mail.example.org or so") for i in range(12)]
    rows += [(50, "please reach me under user77(at)mail.example.org soon"), (51, "reach me under AB1234567 today"),
             (52, "the part AB7654321 is in stock"), (53, None)]
    got = rows_by(pii.redact(frame(rows)), "doc_id")
    assert got[0].text.endswith("reach me under [EMAIL] or so")
    assert got[51].text == "reach me under [ID] today" and got[52].text == rows[14][1] and got[53].text is None


def plain_discovered(rows):
    """Contexts and rounds in plain Python: the spans of kind id of each text."""
    mention = regex.compile(pii.MENTION)
    whole = [(k, re.compile(p), ok) for k, p, ok in KINDS]
    found = []
    for i, text in rows:
        ends = [m.span() for m in mention.finditer(text or "")] if re.search("[0-9@]", text or "") else []
        for n, (a, b) in enumerate(ends):
            before = text[ends[n - 1][1] if n else 0:a][-60:]
            after = text[b:ends[n + 1][0] if n + 1 < len(ends) else len(text)][:60]
            before, after = (re.sub("[0-9]", "0", x.lower()) for x in (before, after))
            value = text[a:b]
            base = any((m := p.fullmatch(value)) and ok(m[0]) for _, p, ok in whole)
            secret = re.fullmatch("[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}", value.lower())
            secret = secret and re.search("[0-9]", value) and re.search("[a-fA-F]", value)
            made = []
            if m := re.search(r"([^\W\d][\w-]*)\s*[:=]\s*[\"'`]?$", before):
                made.append(("key", m[1]))
            if m := re.search(r"(\S+\s+\S+\s*)$", before):
                made.append(("before", m[1]))
            if (m := re.search(r"(\S+\s*)$", before)) and (k := re.match(r"\s*\S+", after)):
                made.append(("around", m[1] + "_" + k[0]))
            made = [x for x in made if any(c.isalpha() for c in x[1])]
            found.append((i, a, b, value.lower(), base, bool(base or secret), made))
    edges = {(p, v) for _, _, _, v, _, _, made in found for p in made}
    seeds = {v for _, _, _, v, _, seed, made in found if seed}
    score, good = {v: 1.0 * (v in seeds) for _, v in edges}, None
    while True:
        by = collections.defaultdict(list)
        for p, v in edges:
            by[p].append(score[v])
        now = {p: sum(x) / len(x) for p, x in by.items() if sum(x) >= pii.SUPPORT and sum(x) / len(x) >= pii.GOOD}
        if good is not None and now.keys() == good.keys():
            break
        good = now
        for v in score:
            score[v] = 1.0 if v in seeds else max([good[p] for p, w in edges if w == v and p in good], default=0.0)
    out = collections.defaultdict(set)
    for i, a, b, _, base, _, made in found:
        if not base and any(p in good for p in made):
            out[i].add((a, b))
    return out


def bootstrap_rows():
    r = random.Random(12)
    mail = lambda i: f"user{i}@mail.example.org"
    rows = [(200 + i, f"{rnd(i, 5)} reach me under {mail(i)} or so") for i in range(30)]
    # Round one: what stands where addresses do. Round two: where those stand. Round three: a key.
    ids = [f"AB{1000000 + i}" for i in range(8)]
    rows += [(20 + k, f"{rnd(90 + k, 4)} reach me under {v} today") for k, v in enumerate(ids[:5])]
    rows += [(30 + k, f"my badge number {v} was lost, {rnd(k, 3)}") for k, v in enumerate(ids[:6])]
    rows += [(40 + k, f"badge_no: {v}; {rnd(k, 3)}") for k, v in enumerate(ids[:7])]
    rows += [(50 + k, f'{rnd(k, 2)} token = "{r.getrandbits(160):040x}" {rnd(k, 3)}') for k in range(6)]
    rows += [(60, 'x token = "zz-not-hex-9" y'), (61, f"the part {ids[7]} is in stock"), (62, "| 9093441080585879 | 12 |"),
             (63, "| 9093441080585878 | 12 |"), (64, None), (65, ""), (20, rows[30][1])]
    rows += [(70 + k, f"{rnd(k, 3)} part no {200000 + k}x in {rnd(k + 50, 2)}") for k in range(8)]
    return rows


def test_pii_rounds_equal_plain_rounds(frame):
    rows = bootstrap_rows()
    df, base, every = pii.spans(frame(rows), ["doc_id", "text"])
    want, got = plain_discovered(rows), collections.defaultdict(set)
    for row in df.select("doc_id", F.inline(every)).where("kind = 'id'").collect():
        got[row.doc_id].add((row.start, row.end))
    assert got == {i: s for i, s in want.items() if s}
    # Every planted identifier and nothing else, through all three rounds.
    assert set(got) == {*range(20, 25), *range(30, 36), *range(40, 47), *range(50, 56), 60}


# --- 8 n-gram Jaccard join -----------------------------------------------------------------------


def shingle_set(x):
    w = re.findall(r"[^\x20\x09-\x0D]+", x or "")
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def plain_classes(rows):
    sets = {t: shingle_set(t) for _, t in rows if shingle_set(t)}
    root = {t: t for t in sets}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    links, texts = collections.Counter(), list(sets)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for i, t in rows:
        if t in root and i is not None:
            least[find(t)] = min(i, least.get(find(t), i))
    return collections.Counter((i, least.get(find(t)) if t in root else i, links[t]) for i, t in rows)


def near_rows():
    r = random.Random(11)
    rows = []
    for g in range(6):
        base = r.choices([f"w{k}" for k in range(400)], k=120)
        for c in range(90 if g == 0 else 6):
            copy = list(base)
            for _ in range(c % 5):
                copy[r.randrange(len(copy))] = f"n{r.random()}"
            rows.append((len(rows) * 3 % 1009, " ".join(copy)))
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "one two"), (2005, "one"),
                   (rows[0][0], rows[0][1]), (None, "null id text of some words"), (2006, "x y " * 20_000)]


def test_ngram_join(frame, monkeypatch):
    rows = near_rows()
    # Several blocks per group, as a large group has.
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 16)
    docs = frame(rows).withColumn("node", F.lit("clash"))
    got = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.classes(docs).collect())
    assert got == plain_classes(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    stay = {(c if c is not None else None) for (_, c, _), n in plain_classes(rows).items()}
    assert set(ids) == stay and max(ids.values()) == 1
    assert ngram_join.classes(docs.limit(0)).count() == 0


def test_prefix_is_shortened_until_recall():
    assert ngram_join.prefix_length(recall=0.5) == ngram_join.LONGEST
    assert ngram_join.prefix_length(threshold=0.1, recall=0.999999) == 1
    walked = ngram_join.depths()
    assert walked[0] == ngram_join.LONGEST and walked == sorted(walked, reverse=True)
    assert ngram_join.met(ngram_join.THRESHOLD, walked[-1]) >= ngram_join.RECALL
    assert ngram_join.met(ngram_join.THRESHOLD, walked[-1] + 1) < ngram_join.RECALL


def edges_of(df):
    return {frozenset((bytes(r.a), bytes(r.b))) for r in df.collect() if r.a != r.b}


def test_texts_stop_at_the_prefix_that_reaches_their_recall(frame, monkeypatch):
    """Close copies stop at the longest prefixes; a text that has met nobody goes on."""
    r = random.Random(4)
    copies = [r.choices([f"w{k}" for k in range(900)], k=400) for _ in range(3)]
    rows = [(10 * g + c, " ".join([*base[:c], f"n{c}", *base[c + 1:]])) for g, base in enumerate(copies) for c in range(8)]
    rows += [(100 + i, " ".join(r.choices([f"w{k}" for k in range(900)], k=400))) for i in range(6)]
    seen = []
    walk = ngram_join._met_at
    monkeypatch.setattr(ngram_join, "_met_at", lambda nodes, n: (
        seen.append((n, nodes.where("waiting").count())), walk(nodes, n))[1])
    nodes = ngram_join.signatures(frame(rows)).select("node", "signature")
    groups = collections.Counter(r.root for r in ngram_join.candidate_groups(nodes).collect())
    assert [n for n, _ in seen] == ngram_join.depths()
    assert seen[0][1] == 30 and seen[1][1] <= 10 and sorted(groups.values())[-3:] == [8, 8, 8]


def test_long_runs_are_dealt_over_tasks(spark, frame, monkeypatch):
    rows = near_rows()
    monkeypatch.setattr(ngram_join, "HOT", 8)
    got = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.classes(frame(rows)).collect())
    assert got == plain_classes(rows)


def test_recall_of_pairs_near_the_threshold(frame):
    """Pairs of sets whose similarity lies between 0.8 and 0.85, against brute force."""
    r = random.Random(6)
    rows, wanted = [], set()
    for k in range(250):
        base = [f"v{k}x{i}" for i in range(300)]
        other, changes = list(base), r.randrange(5, 8)
        for spot in range(changes):
            other[20 + 40 * spot] = "changed"
        a, b = shingle_set(" ".join(base)), shingle_set(" ".join(other))
        if 0.8 <= len(a & b) / len(a | b) < 0.9:
            wanted.add(2 * k)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    linked = {r.doc_id for r in ngram_join.classes(frame(rows)).where("n_links > 0 and doc_id % 2 = 0").collect()}
    assert len(wanted) > 100 and linked <= wanted
    assert len(linked & wanted) >= 0.99 * len(wanted)


# --- 9 decontamination ------------------------------------------------------------------------------


def test_decontamination(spark, frame):
    item = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix green potions"
    a, b = item[:43], item[44:]
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item)], "item_id bigint, text string")
    docs = frame([(1, f"x y {item.upper()}! z"), (2, f"{rnd(1, 30)} {b} {rnd(2, 9)} {a} {rnd(3, 9)}"), (3, rnd(4, 200)),
                  (4, None), (5, ""), (6, "the quick brown fox jumps away"), (1, f"x y {item.upper()}! z"), (None, item),
                  (7, "too short, this")]).withColumn("digest", F.lit("clash"))
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == {(1, 1): 2, (1, 5): 2, (2, 1): 1, (2, 5): 1, (None, 1): 1, (None, 5): 1, (7, 4): 1}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def plain_tiles(a, b, least):
    used_a, used_b, out = set(), set(), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while (i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]
                       and i + k not in used_a and j + k not in used_b):
                    k += 1
                if k >= least and (best is None or k > best[0]):
                    best = (k, i, j)
        if best is None:
            return out
        out.append(best)
        used_a |= set(range(best[1], best[1] + best[0]))
        used_b |= set(range(best[2], best[2] + best[0]))


def plain_tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_matches(docs, bench):
    """Every text tiled with every item."""
    out = collections.Counter()
    for d, text in docs:
        for i, item in bench:
            own = plain_tokens(item)
            found = plain_tiles(own, plain_tokens(text), min(decontaminate.LEAST, len(own))) if own and text else []
            n = sum(k for k, _, _ in found)
            if own and n / len(own) >= decontaminate.COVERAGE:
                out[d, i, len(found), n, len(own)] += 1
    return out


def test_no_pair_is_missed(spark, frame):
    r = random.Random(8)
    letters = [chr(c) for c in range(97, 117)]
    items = [(i, " ".join(r.choices(letters, k=r.randint(0, 18)))) for i in range(25)]
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    w = item.split()
    items += [(90, item), (91, "four words stand here"), (92, item), (93, None), (94, "日本語 の テスト です"), (95, "solo")]
    runs = [" ".join(x) for x in (w[12:16], w[0:3], w[7:10], w[3:7], w[10:12])]
    docs = [(i, " ".join(r.choices(letters, k=r.randint(0, 60)))) for i in range(40)]
    docs += [(100, " x y ".join(runs)), (101, item.replace(" ", "\u2014") + "\u2019s"), (102, "a FOUR words\u00a0stand\u2026here b"),
             (103, "solo"), (104, "日本語、の「テスト」です。"), (105, None), (106, ""), (100, " x y ".join(runs))]
    docs += [(200 + i, f"{items[i][1]} {r.choice(letters)}") for i in range(20)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(frame(docs).repartition(3), bench).collect()
    got = collections.Counter((x.doc_id, x.item_id, x.n_tiles, x.matched_tokens, x.item_tokens) for x in found)
    assert got == plain_matches(docs, items)
    assert {(d, i) for d, i, *_ in got} >= {(100, 90), (100, 92), (101, 90), (102, 91), (103, 95), (104, 94)}


def test_a_long_text_is_tiled_in_time(spark, frame):
    w = [f"w{i % 700}" for i in range(60_000)]
    bench = spark.createDataFrame([(i, " ".join(w[i:i + 40])) for i in range(30)], "item_id bigint, text string")
    assert decontaminate.contaminated(frame([(1, " ".join(w))]), bench).count() == 30


def test_tiles_equal_plain_search():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.randrange(4) for _ in range(r.randrange(25))] for _ in range(2))
        assert decontaminate.tiles(a, b) == plain_tiles(a, b, decontaminate.LEAST)


def test_filters_hold_every_seed(spark):
    seeds = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 5000)
    bits = decontaminate.seed_filter(spark.createDataFrame([(int(x),) for x in seeds], "seed bigint"))
    assert decontaminate.passes(bits, seeds).all()
    others = np.random.default_rng(4).integers(-(1 << 63), 1 << 63, 50_000)
    assert decontaminate.passes(bits, others).mean() < 0.1


# --- 10 token counts ---------------------------------------------------------------------------------


def test_token_counts(frame):
    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = odd_rows()
    got = token_counts.token_counts(frame(rows), P.path("word_bpe_49k.json"), ["doc_id"], limit=100).collect()
    want = collections.Counter()
    for i, t in rows:
        n = len(tk.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 100] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert token_counts.token_counts(frame([]), P.path("word_bpe_49k.json")).count() == 0


def test_token_counts_before_signs_after_any_letter(frame):
    """Lower-casing and composing may leave a mark that belongs to the sign after it."""
    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0xA0, 0x3000) if chr(c).isalnum() or unicodedata.category(chr(c))[0] == "M"]
    r = random.Random(7)
    letters = [*"\u0130\u01c5\u1e9e\u00df\ufb01", *r.sample(letters, 2500)]
    rows = ["\u0130.", "Ankara'da \u0130. Kaya", "\u0130STANBUL\u0130, x"]
    rows += ["".join(f"{c}{sign}{d}" for sign in ".,'- \n" for d in r.sample(letters, 1)) for c in letters]
    got = token_counts.token_counts(frame(list(enumerate(rows))), P.path("word_bpe_49k.json"), ["doc_id"]).collect()
    for row in got:
        text = rows[row.doc_id]
        assert row.n_tokens == len(tk.encode(text, add_special_tokens=False).ids), ascii(text)


def test_byte_level_counts_and_refused_tokenizers(frame, tmp_path):
    path = P.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    rows = odd_rows()
    got = token_counts.token_counts(frame(rows), path, ["doc_id"], limit=100).select("doc_id", "n_tokens").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(
        (i, len(tk.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    odd = json.load(open(path, encoding="utf-8"))
    for other in ({"type": "Metaspace"}, {"type": "Split", "pattern": {"Regex": "a b"}, "behavior": "Removed", "invert": True}):
        odd["pre_tokenizer"] = other
        (tmp_path / "odd.json").write_text(json.dumps(odd))
        if "pattern" in other:
            odd["pre_tokenizer"]["pattern"]["Regex"] = r"\s+a"
            (tmp_path / "odd.json").write_text(json.dumps(odd))
        with pytest.raises(ValueError):
            token_counts.safe_cut(str(tmp_path / "odd.json"))


def test_memory_is_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_CHARS", 100)
    known = pieces.Memory(lambda new: [p.upper() for p in new])
    for k in range(50):
        batch = [f"{k}-{i}" * 5 for i in range(3)]
        known.learn(batch)
        assert [known[p] for p in batch] == [p.upper() for p in batch] and sum(map(len, known)) <= 150


def test_clashing_columns_get_longer_names(frame, codec):
    docs = frame([(1, "a b")]).withColumn("n_tokens", F.lit("mine")).withColumn("score", F.lit("mine"))
    counted = token_counts.token_counts(docs, P.path("word_bpe_49k.json"))
    assert tuple(counted.select("n_tokens", "n_tokens_").first()) == ("mine", 2)
    coded = byte_bpe.round_trip(docs, codec[0], docs.columns)
    assert tuple(coded.select("n_tokens", "n_tokens_").first()) == ("mine", 2)
    found = language_id.fit(docs.withColumn("lang", F.lit("en")), F.lit(True))
    assert language_id.predict(docs, found).select("score", "score_").first()[0] == "mine"


# --- queries and pipeline ------------------------------------------------------------------------------


def test_pipeline(spark, codec):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    done = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    judged, q = quality.judge(docs, ["doc_id", "lang"])
    left = {r.doc_id for r in judged.where(F.col(q)["kept"]).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in left]
    left = {c for _, c, _ in plain_classes(rows)}
    bench = [plain_tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for i, t in rows:
        if i in left:
            w = plain_tokens(t)
            runs = {tuple(w[k:k + 3]) for k in range(len(w) - 2)}
            near = [b for b in bench if len({k + j for k in range(len(b) - 2) if tuple(b[k:k + 3]) in runs
                                             for j in range(3)}) >= 0.6 * len(b)]
            tiles, sizes = [plain_tiles(b, w, 3) for b in near], [len(b) for b in near]
            if not any(sum(k for k, _, _ in t) >= 0.6 * n for t, n in zip(tiles, sizes)):
                kept[i] = t
    assert set(done) == set(kept)
    for i, r in done.items():
        text = codec[0].decode(r.ids).decode()
        assert r.n_tokens == len(r.ids) and codec[1].encode_ordinary(text) == r.ids
        for kind, pattern, ok in KINDS:
            assert not any(ok(m[0]) for m in re.finditer(pattern, text))
        if not re.search("[0-9@]", kept[i]):
            assert text == kept[i]


def test_full_memory_still_knows_all_pieces_of_a_batch():
    from packetlens.llm.pieces import Memory

    known = Memory(lambda pieces: map(len, pieces), 3)
    for batch in (["a", "bb"], ["a", "ccc", "dddd"], ["e", "ff", "a", "g", "h"], ["a"]):
        known.learn(p for p in batch)
        assert [known[p] for p in batch] == list(map(len, batch))
