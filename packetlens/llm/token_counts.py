"""Token counts by batch encoding inside Arrow functions, which return lengths only.

Arrow batches are cut into runs of about equal bytes. Texts are split at boundaries that are
safe for the tokenizer (``safe_cut`` reads them from its file), so a long text costs no more
memory than a short one, and a piece that occurs often is encoded once.

* A null text counts as empty: no bytes, no tokens. Repeated rows are counted alike.
* Special tokens spelt out in a text count as the tokenizer's default says.
* Extra columns are passed through, and a column added beside one of its name gets a longer name;
  an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from packetlens.llm.common import map_texts
from packetlens.llm.pieces import CUT, WHITE, memory

# Tokens that a training context holds.
LIMIT = 2048
# Bytes of pieces that are encoded as one text.
TOGETHER = 16_000
SCHEMA = "n_bytes bigint, n_tokens bigint, over_limit boolean"
# Parts of a pattern: a class that leaves out white space, and signs that may match it.
NO_SPACE = regex.compile(r"\[\^[^\]\[]*\\s[^\]\[]*\]")
MAY_BE_SPACE = regex.compile(r"\\[sWDPXRhvxu0]|\\p\{[ZC]|\.|\[\^|\s")
# A character that is a token of its own between spaces.
MARK = "\1"


def safe_cut(tokenizer_file: str) -> tuple[Callable[[str], list[str]], bool]:
    """How texts may be cut for a tokenizer, and whether it drops white space. One that splits by a pattern and drops what lies
    between the matches may be cut at every space and line feed, if the pattern matches no
    white space: the characters beside it are in no common match, whatever its normalizer makes
    of them. A byte-level one with the usual pattern may be cut before a space that something
    other than white space follows. Others are refused."""
    with open(tokenizer_file, encoding="utf-8") as f:
        split = json.load(f)["pre_tokenizer"]
    parts = split.get("pretokenizers", [split])
    first = parts[0]
    if first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]:
        pattern = first["pattern"].get("Regex", "")
        # What is left without classes that exclude white space must not be able to match any.
        rest = NO_SPACE.sub("", pattern)
        if pattern and not MAY_BE_SPACE.search(rest) and not regex.search(pattern, WHITE):
            return lambda text: text.replace("\n", " ").split(" "), True
    elif first["type"] == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]:
        return lambda text: [p for p in CUT.split(text) if p], False
    raise ValueError(f"no safe boundary is known for the pre-tokenizer of {tokenizer_file}")


def counter(tokenizer, drops_space: bool):
    """A function from pieces to their token counts. Where white space is dropped, pieces are
    joined with a mark between them, whose token tells where each ends."""
    mark = tokenizer.encode(MARK, add_special_tokens=False).ids
    between = f" {MARK} "

    def one_by_one(pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _runs(chosen: list[int], pieces: list[str]):
        part, size = [], 0
        for i in chosen:
            part.append(i)
            size += len(pieces[i]) + len(between)
            if size >= TOGETHER:
                yield part
                part, size = [], 0
        if part:
            yield part

    def count(pieces: list[str]) -> list[int]:
        out = [0] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if drops_space and MARK not in p]
        odd = [i for i, p in enumerate(pieces) if not drops_space or MARK in p]
        for part in _runs(plain, pieces):
            joined = between.join(pieces[i] for i in part)
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids)
            ends = np.append(np.flatnonzero(ids == mark[0]), len(ids)) if len(mark) == 1 else ()
            if len(ends) == len(part):
                sizes = np.diff(ends, prepend=-1) - 1
            else:
                sizes = one_by_one([pieces[i] for i in part])
            for i, n in zip(part, sizes, strict=True):
                out[i] = int(n)
        for i, n in zip(odd, one_by_one([pieces[i] for i in odd]), strict=True):
            out[i] = n
        return out

    return count


def token_counts(docs: DataFrame, tokenizer_file: str, keep: list[str] | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """Add n_bytes, n_tokens and over_limit of ``text``. ``tokenizer_file`` is read on each
    executor."""

    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        cut, drops_space = safe_cut(tokenizer_file)
        known = memory(
            f"counts {tokenizer_file}", lambda: counter(Tokenizer.from_file(tokenizer_file), drops_space))

        def work(texts):
            pieces = [cut(t or "") for t in texts]
            known.learn(chain.from_iterable(pieces))
            tokens = [sum(map(known.__getitem__, text)) for text in pieces]
            return {
                "n_bytes": [len((t or "").encode()) for t in texts],
                "n_tokens": tokens,
                "over_limit": [n > limit for n in tokens],
            }

        return work

    return map_texts(docs, "text", make, SCHEMA, keep)
