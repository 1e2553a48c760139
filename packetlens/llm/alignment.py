"""Tokens of two tokenizers over the same bytes, aligned.

Each text is encoded twice: a space and the text by a byte-level tokenizer (A), and the text by
a sentencepiece model (B), which adds that space itself. The byte offsets at which tokens end are
kept in a dictionary from end to index for either side. The offsets in both dictionaries, sorted,
slice the two id lists into groups; inside a group no end is shared, so its links (pairs of
tokens whose bytes overlap) are read off by walking both ends.

Both tokenizers are asked for pieces of a text: tokens of both end before a space, around a line
feed, and before a comma or full stop after a letter or digit, so the groups of a text are those
of its pieces. That none of B's tokens crosses such a place is read from its vocabulary; for a
model with tokens across spaces or line feeds texts are taken whole.

How often an id pair is linked is counted over all texts. The most frequent pairs (at most
``FREQUENT``) are given to every task; the links of the others meet their counts in a join,
and no pair there is frequent enough to be a hot key.

* A null or empty text has no tokens, nor has one whose tokens of A or B do not join to the
  space and the text. Repeated rows are aligned and counted each.
* Strings that look like special tokens are ordinary text.
* Extra columns are passed through under any name; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from packetlens.llm.common import fresh, slices
from packetlens.llm.pieces import unsafe

# A space after something that is neither white space nor B's sign for a space; the only cuts
# in texts with longer white space or punctuation that may belong to what precedes it.
CUT = re.compile(r"(?<=[^\s▁])(?= )")
SPACE = "▁"
BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
# An id pair is one number: A's id times this, and B's id; both are smaller.
SHIFT = 1 << 20
# Pieces that a Python process remembers, and encodes together.
REMEMBERED = 800_000
TOGETHER = 1000
# Pairs given to every task at most, as two numbers of 8 bytes and a flag.
FREQUENT = 1 << 20
RESULT = ("row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
          "pairs array<bigint>, times array<int>")


def byte_level_table() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a character: printable ones as themselves,
    the others as the characters from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def overlapping(a: list[int], b: list[int], tokens_a: list[bytes], tokens_b: list[bytes]) -> list[int]:
    """The id pairs of a group's tokens whose bytes overlap; no end is shared but the last."""
    ends_a, ends_b = list(accumulate(map(len, tokens_a))), list(accumulate(map(len, tokens_b)))
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        out.append(a[i] * SHIFT + b[j])
        x, y = ends_a[i], ends_b[j]
        i, j = i + (x <= y), j + (y <= x)
    return out


class Store:
    """What is known of pieces, by number: tokens and groups, the groups as text, and links."""

    def __init__(self):
        self.index: dict = {}
        self.numbers, self.starts, self.links = array("q"), array("q", [0]), array("q")
        self.groups: list[str] = []
        # Pieces whose tokens are not their text.
        self.odd: set[int] = set()

    def add(self, piece, found: tuple | None) -> int:
        at = self.index[piece] = len(self.groups)
        if found is None:
            self.odd.add(at)
            found = 0, 0, 0, "", ()
        self.numbers.extend(found[:3])
        self.groups.append(found[3])
        self.links.extend(found[4])
        self.starts.append(len(self.links))
        return at

    def row(self, piece) -> tuple | None:
        at = self.index[piece]
        if at in self.odd:
            return None
        return *self.numbers[3 * at:3 * at + 3], self.groups[at], self.links[self.starts[at]:self.starts[at + 1]]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.asarray(self.numbers).reshape(-1, 3), np.asarray(self.starts), np.asarray(self.links)


class Aligner:
    """Aligns pieces of texts; remembers those seen."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        table = byte_level_table()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            # A special token's characters need not be in the table; it is never given out.
            self.bytes_a[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := BYTE.fullmatch(p))
                        else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in names)
        self.joined = {x for p in names for x in re.findall(r"[^\W_][.,]", p)}
        # What B gives for a line feed, with the space it adds.
        self.feed = self.b.encode("\n")
        if max(len(self.bytes_a), len(names)) > SHIFT:
            raise ValueError(f"a vocabulary has more than {SHIFT} tokens")
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(names)))]
        self.known, self.older = Store(), Store()

    def pieces(self, text: str) -> list[str]:
        """Parts of a space and ``text``."""
        raw = " " + text
        if not self.cuts:
            return [raw]
        if unsafe(raw) or SPACE in raw or any(x in raw for x in self.joined):
            return CUT.split(raw)
        marked = raw.replace(" ", "\0 ").replace("\n", "\0\n\0").replace(",", "\0,").replace(".", "\0.")
        return [p for p in marked.split("\0") if p]

    def ids_b(self, pieces: list[str]) -> list[list[int]]:
        """B's ids of pieces. It adds a space to each: one that has its own gives it up, and
        another is asked for after a line feed, whose ids are cut off."""
        n = len(self.feed)
        found = self.b.encode([p[1:] if p[0] == " " else "\n" + p for p in pieces], num_threads=1)
        return [x if p[0] == " " else x[n:] if x[:n] == self.feed else [] for p, x in zip(pieces, found, strict=True)]

    def learn(self, pieces: set[str]) -> None:
        """Have all pieces in ``known``. When that is half of what may be remembered it becomes
        the older half, from which pieces that are met again come back."""
        new = pieces.difference(self.known.index)
        if 2 * (len(self.known.index) + len(new)) > REMEMBERED and self.known.index:
            self.older, self.known, new = self.known, Store(), pieces
        again = new & self.older.index.keys()
        for p in again:
            self.known.add(p, self.older.row(p))
        new = list(new - again)
        for start in range(0, len(new), TOGETHER):
            part = new[start:start + TOGETHER]
            ids_a = [e.ids for e in self.a.encode_batch_fast(part, add_special_tokens=False)]
            for p, x, y in zip(part, ids_a, self.ids_b(part), strict=True):
                self.known.add(p, self.one(p.encode(), x, y))

    def one(self, raw: bytes, a: list[int], b: list[int]) -> tuple | None:
        """Numbers of tokens and groups, the groups as text, and the links as id pairs; None if
        the tokens are not the text."""
        bytes_a, bytes_b, names = self.bytes_a, self.bytes_b, self.names
        tokens_a, tokens_b = [bytes_a[i] for i in a], [bytes_b[i] for i in b]
        if b"".join(tokens_a) != raw or b"".join(tokens_b) != raw:
            return None
        names_a, names_b = [names[i] for i in a], [names[i] for i in b]
        n, m = len(a), len(b)
        if n == 1 or m == 1:
            # All ends but the last belong to one side.
            return n, m, 1, f"{','.join(names_a)}|{','.join(names_b)}", [x * SHIFT + y for x in a for y in b]
        # Number of tokens up to each end.
        index_a = dict(zip(accumulate(map(len, tokens_a)), count(1)))
        index_b = dict(zip(accumulate(map(len, tokens_b)), count(1)))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(index_a.keys() & index_b.keys()):
            k, m = index_a[end], index_b[end]
            if k - i == 1 and m - j == 1:
                links.append(a[i] * SHIFT + b[j])
                groups.append(f"{names_a[i]}|{names_b[j]}")
            else:
                if k - i == 1 or m - j == 1:
                    links += [x * SHIFT + y for x in a[i:k] for y in b[j:m]]
                else:
                    links += overlapping(a[i:k], b[j:m], tokens_a[i:k], tokens_b[j:m])
                groups.append(f"{','.join(names_a[i:k])}|{','.join(names_b[j:m])}")
            i, j = k, m
        return n, len(b), len(groups), ";".join(groups), links

    def whole(self, text: str) -> tuple | None:
        raw = " " + text
        a = self.a.encode_batch_fast([raw], add_special_tokens=False)[0].ids
        return self.one(raw.encode(), a, self.b.encode([text], num_threads=1)[0])

    def texts(self, texts: list[str | None]) -> dict:
        """For each text its numbers, groups, and distinct linked pairs; ``sizes`` has how many
        of these it has."""
        cut = [self.pieces(t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(cut)))
        known = self.known
        at = [list(map(known.index.__getitem__, pieces)) for pieces in cut]
        for i, own in enumerate(at):
            if not known.odd.isdisjoint(own):
                # A sign that stands for a space: only the whole text tells.
                found = self.whole(texts[i])
                at[i] = [known.add((texts[i],), found)] if found else []
        n = np.array([len(own) for own in at], "i8")
        flat = np.fromiter(chain.from_iterable(at), "i8", int(n.sum()))
        numbers, starts, links = known.arrays()
        ends = np.concatenate([[0], np.cumsum(n)])
        totals = np.concatenate([np.zeros((1, 3), "i8"), np.cumsum(numbers[flat], 0)])
        sums = np.diff(totals[ends], axis=0)
        # The links of all pieces in a row, under the number of their text.
        size = starts[flat + 1] - starts[flat]
        place = np.arange(int(size.sum())) + np.repeat(starts[flat] - np.cumsum(size) + size, size)
        text = np.repeat(np.repeat(np.arange(len(at)), n), size)
        both, times = np.unique(text * SHIFT * SHIFT + links[place], return_counts=True)
        return {
            "n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2],
            "n_links": np.bincount(text, minlength=len(at)),
            "groups": [";".join(map(known.groups.__getitem__, own)) for own in at],
            "sizes": np.bincount(both // (SHIFT * SHIFT), minlength=len(at)),
            "pairs": both % (SHIFT * SHIFT), "times": times,
        }


_aligners: dict[tuple[str, str], Aligner] = {}


def align(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, str]:
    """All columns and a struct, whose name is returned as well: row (a number of its own, for
    as long as the result is stored), n_a, n_b, n_groups, n_links, groups (ids of A, a bar and
    ids of B for each group), and the distinct linked id pairs of the text (A's id * 2^20 + B's
    id) with the times each is linked. The files are read on each executor."""
    name = fresh(docs.columns, "aligned")
    kind = StructType.fromDDL(RESULT)
    fields = list(to_arrow_schema(kind))
    passed = docs.columns

    def run(batches: Iterator[pa.RecordBatch]):
        key = (path_a, path_b)
        own = _aligners.get(key) or _aligners.setdefault(key, Aligner(*key))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                got = own.texts(part["text"].to_pylist())
                ends = pa.array(np.concatenate([[0], np.cumsum(got["sizes"])]), pa.int32())
                columns = [
                    pa.array(np.arange(row, row + part.num_rows)),
                    *(pa.array(got[c]) for c in ("n_a", "n_b", "n_groups", "n_links", "groups")),
                    *(pa.ListArray.from_arrays(ends, pa.array(got[c])) for c in ("pairs", "times")),
                ]
                row += part.num_rows
                columns = [c.cast(f.type) for c, f in zip(columns, fields, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.StructArray.from_arrays(columns, fields=fields)], [*passed, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, kind)), name


def link_counts(rows: DataFrame, name: str) -> DataFrame:
    """pair, n (its links in all texts) and best (whether no other pair of its B id has more),
    from the struct ``name`` that ``align`` gives."""

    def add_up(batches: Iterator[pa.RecordBatch]):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed():
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in held]), len(keys)).astype("i8")

        for batch in batches:
            held.append((np.asarray(batch["pairs"].flatten()), np.asarray(batch["times"].flatten(), "i8")))
            if sum(len(k) for k, _ in held) > FREQUENT * 2:
                held = [summed()]
                if len(held[0][0]) > FREQUENT:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], ["pair", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed()], ["pair", "n"])

    lists = rows.select(f"`{name}`.pairs", f"`{name}`.times").where(F.size("pairs") > 0)
    counts = lists.mapInArrow(add_up, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("b", F.col("pair") % SHIFT)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The pairs with the most links, at most ``limit``, sorted, with n and best; and the count
    from which on all are there. It is a power of two, found from a histogram of 63 rows."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["k"] for r in counts.groupBy(power.alias("p")).agg(F.count("*").alias("k")).collect()}
    total, least = 0, 62
    while least and total + sizes.get(least - 1, 0) <= limit:
        least -= 1
        total += sizes.get(least, 0)
    rows = counts.where(F.col("n") >= (1 << least)).orderBy("pair").toArrow()
    return (np.asarray(rows["pair"], "i8"), np.asarray(rows["n"], "i8"),
            rows["best"].to_numpy().astype(bool), 1 << least)


def with_counts(rows: DataFrame, name: str, counts: DataFrame, limit: int = FREQUENT) -> tuple[DataFrame, str]:
    """All columns and a struct, whose name is returned as well: n_best, the links whose pair is
    the most frequent of its B id, and count_sum, the counts of all links added up. ``rows`` and
    ``counts`` are stored tables, from ``align`` and ``link_counts``."""
    *top, least = frequent(counts, limit)
    shared = rows.sparkSession.sparkContext.broadcast(top)
    linked = fresh(rows.columns, "linked")
    kind = StructType.fromDDL("n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>")
    fields = list(to_arrow_schema(kind))

    def look_up(batches: Iterator[pa.RecordBatch]):
        pair, n, best = shared.value
        for batch in batches:
            lists, times = (batch[name].field(c) for c in ("pairs", "times"))
            ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
            lists, times = np.asarray(lists.flatten(), "i8"), np.asarray(times.flatten(), "i8")

            def sums(values):
                return np.diff(np.concatenate([[0], np.cumsum(values)])[ends]).astype("i8")

            found, at = np.zeros(len(lists), bool), np.zeros(len(lists), "i8")
            if len(pair):
                at = np.minimum(np.searchsorted(pair, lists), len(pair) - 1)
                found = pair[at] == lists
            here = at[found]
            counted, bests = np.zeros(len(lists), "i8"), np.zeros(len(lists), "i8")
            counted[found], bests[found] = times[found] * n[here], times[found] * best[here]
            left = pa.array(np.concatenate([[0], np.cumsum(sums(~found))]), pa.int32())
            columns = [pa.array(sums(bests)), pa.array(sums(counted)),
                       *(pa.ListArray.from_arrays(left, pa.array(x[~found])) for x in (lists, times))]
            columns = [c.cast(f.type) for c, f in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.StructArray.from_arrays(columns, fields=fields)], [*batch.schema.names, linked])

    found = rows.mapInArrow(look_up, StructType([*rows.schema.fields]).add(linked, kind))
    if least == 1:
        return found.withColumn(linked, F.col(linked).dropFields("pairs", "times")), linked
    zipped = F.inline(F.arrays_zip(f"{linked}.pairs", f"{linked}.times")).alias("pair", "t")
    rest = found.select(F.col(f"`{name}`.row").alias("row"), zipped).join(counts.where(F.col("n") < least), "pair")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("n_best"), F.sum(F.col("t") * F.col("n")).alias("count_sum"))
    rest = rest.select(F.col("row").alias(fresh(found.columns, "row")), F.struct("n_best", "count_sum").alias(fresh(found.columns, "rest")))
    row, more = rest.columns
    total = F.struct(*[(F.col(linked)[c] + F.coalesce(F.col(more)[c], F.lit(0))).alias(c) for c in ("n_best", "count_sum")])
    return found.join(rest, F.col(f"`{name}`.row") == F.col(row), "left").select(
        *[f"`{c}`" for c in rows.columns], total.alias(linked)), linked
