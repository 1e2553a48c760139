"""Language identification by interpolated Kneser-Ney character models.

One model per language is counted by Spark from a bounded sample of labelled rows and stored
in sorted hash arrays. A text gets the language whose model needs the fewest nats per letter.
A part of the sample is kept out of the counts: it sets the steepness of the score and, for
each language, the cross-entropy beyond which a prediction counts as rejected.

* A text that is null or has no letter is ``und`` with score 0 and not rejected.
* Rows without label or eligibility are not learned from; with none at all every text is ``und``.
* Equal cross-entropies go to the language first in sorted order.
* Repeated rows are predicted alike; extra columns are passed through, and a column added beside
  one of its name gets a longer name. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetlens.llm import char_lm
from packetlens.llm.common import map_texts, stored

ORDER = 4
# Labelled rows per language that a model is learned from, about.
SAMPLE_ROWS = 3000
# Languages up to which their sizes are broadcast; beyond, texts are joined to them.
MANY_LANGS = 10_000
# One sampled row in so many calibrates instead of being counted.
CALIBRATE_ONE_IN = 6
# Share of rightly labelled calibration rows that may be rejected.
REJECTED = 0.002
UNDECIDED = "und"
SCHEMA = "lang_pred string, score double, nats double, rejected boolean"


@dataclass
class Identifier:
    """Languages, their models, and the joint array of all their n-grams."""

    langs: list[str]
    models: list[char_lm.CharModel]
    joint: char_lm.HashArray | None = None
    log_p: np.ndarray | None = None
    steepness: float = 1.0
    worst: np.ndarray | None = None

    def __post_init__(self):
        if self.models:
            seen = np.unique(np.concatenate([m.levels[ORDER][0].keys for m in self.models]))
            self.joint = char_lm.HashArray(seen)
            self.log_p = np.stack([m.log_p(self.joint.keys) for m in self.models], 1)
        self.worst = np.full(len(self.langs), np.inf)

    def entropies(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nats per letter of each text under each model, and its number of letters."""
        texts = [t.lower() for t in texts]
        codes = char_lm.codes_of(texts, ORDER, table, True)
        ends = codes[ORDER - 1:]
        real = ends != char_lm.PAD
        keys, letter = char_lm.packed(codes, ORDER)[real], (ends != char_lm.OTHER)[real]
        lengths = np.array([len(t) for t in texts])
        letters = char_lm.segment_sums(letter.astype("f8"), lengths)
        n_of = char_lm.segment_sums(letter, lengths).astype("i8")
        keys = keys[letter]
        at = self.joint.find(keys)
        log_p = self.log_p[at]
        miss = np.flatnonzero(at < 0)
        for k, model in enumerate(self.models if len(miss) else ()):
            log_p[miss, k] = model.log_p(keys[miss])
        return -char_lm.segment_sums(log_p, n_of) / np.maximum(letters, 1)[:, None], n_of

    def predict(self, texts: list[str | None], table: np.ndarray) -> dict:
        n = len(texts)
        if not self.langs:
            return {"lang_pred": [UNDECIDED] * n, "score": np.zeros(n), "nats": np.zeros(n),
                    "rejected": np.zeros(n, bool)}
        nats, letters = self.entropies([t or "" for t in texts], table)
        best = nats.argmin(1)
        least = nats[np.arange(n), best]
        score = 1 / np.exp(-self.steepness * (nats - least[:, None])).sum(1)
        none = letters == 0
        return {
            "lang_pred": [UNDECIDED if u else self.langs[b] for u, b in zip(none, best, strict=True)],
            "score": np.where(none, 0, score), "nats": np.where(none, 0, least),
            "rejected": ~none & (least > self.worst[best]),
        }


def labelled_sample(docs: DataFrame, eligible: Column, rows: int) -> DataFrame:
    """About ``rows`` eligible rows per language, chosen by a hash of doc_id."""
    usable = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = stored(usable.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    if sizes.count() <= MANY_LANGS:
        # Few rows of a label and a number: texts are sampled without moving them.
        sizes = F.broadcast(sizes)
    chance = (F.xxhash64(F.col("doc_id"), F.lit(7)).bitwiseAND(F.lit((1 << 30) - 1))) / F.lit(1 << 30)
    return (
        usable.select("doc_id", "lang", "text").join(sizes, "lang")
        .where(chance < F.lit(rows) / F.col("n"))
        .select("lang", "text", (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)),
                                        F.lit(CALIBRATE_ONE_IN)) == 0).alias("calibrates"))
    )


def fit(docs: DataFrame, eligible: Column, rows: int = SAMPLE_ROWS) -> Identifier:
    """Learn from the rows of ``docs`` (doc_id, text, lang) for which ``eligible`` is true."""
    sample = stored(labelled_sample(docs, eligible, rows), "language-sample")
    counts = char_lm.count_ngrams(sample.where(~F.col("calibrates")), "lang", "text", ORDER, True).toArrow()
    names = np.array(counts["grp"].to_pylist(), object)
    ngrams, n = counts["ngram"].to_numpy(), counts["n"].to_numpy()
    langs = sorted(set(names.tolist()))
    found = Identifier(langs, [
        char_lm.CharModel(ngrams[names == x], n[names == x], ORDER, False) for x in langs
    ])
    if langs:
        calibrate(found, predict(sample.where("calibrates"), found, ["lang"]))
    return found


def calibrate(found: Identifier, judged: DataFrame) -> None:
    """Set steepness so that scores match how often predictions are right, and the limits of
    rejection. The rows are at most those of the sample kept out of the counts."""
    rows = judged.where(F.col("lang_pred") != UNDECIDED).select(
        "lang", "lang_pred", "score", "nats").toArrow().to_pydict()
    right = np.array([a == b for a, b in zip(rows["lang"], rows["lang_pred"], strict=True)], bool)
    if not len(right):
        return
    # score s at steepness 1 has odds s / (1 - s), whose log grows with the steepness.
    odds = np.log(np.clip(rows["score"], 1e-9, 1 - 1e-9)) - np.log1p(-np.clip(rows["score"], 1e-9, 1 - 1e-9))
    tries = np.geomspace(0.5, 64, 29)
    loss = [np.logaddexp(0, np.where(right, -1, 1) * k * odds).mean() for k in tries]
    found.steepness = float(tries[int(np.argmin(loss))])
    nats, pred = np.array(rows["nats"]), np.array(rows["lang_pred"], object)
    for k, lang in enumerate(found.langs):
        own = nats[right & (pred == lang)]
        if len(own):
            found.worst[k] = np.quantile(own, 1 - REJECTED)


def predict(docs: DataFrame, found: Identifier, keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred, score, nats per letter and rejected, from ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def make():
        table, model = char_lm.class_table(True), shared.value
        return lambda texts: model.predict(texts, table)

    return map_texts(docs, "text", make, SCHEMA, keep)
