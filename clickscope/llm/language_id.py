"""Language ID by Bayesian evidence fusion.

Evidence for a row: the likelihood of its whole text under byte-trigram models
(one per language), the language its markup declares, the address suffix and
the host.  Declared values and hosts enter as grouped counts: each row adds
its vote (text posterior times a fixed trust in what it declares) to its host,
suffix and declared value; a host's language prior is smoothed towards its
suffix, a suffix's towards the corpus.

Trigram models are fitted on labelled rows, about ``fit_rows`` per language
(distinct texts with the smallest hashes, one row each); everything else counts
every row.

Defined cases: null or empty text, or a text without letters, has no language
(``lang`` null, rejected); a null host or declared value is a value of its own;
equal rows get equal answers; an empty table gives an empty result; other
columns are ignored.  Without any labelled row nothing can be fitted: every
row has ``lang`` null and is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.tables import bounded_batches, row_key, small_side
from clickscope.llm.textops import slices
from clickscope.session import cut_lineage

BUCKETS = 1 << 13
MAX_LANGS = 200
#: How far a declared language is believed before any count.
TRUST = 0.9

_CLASS = np.full(256, 32, dtype=np.uint8)          # anything else: a gap
for _c in range(97, 123):
    _CLASS[_c], _CLASS[_c - 32] = _c, _c
_CLASS[128:] = np.arange(128, 256)                  # bytes of other scripts


def trigrams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram with at least two letter bytes, or with one
    between gaps, and the row it belongs to.  A text stands between gaps."""
    row_of = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    c = np.full(len(buf) + 2 * len(offs), 32, np.uint32)
    c[np.arange(len(buf)) + 2 * (row_of + 1)] = _CLASS[buf]
    letter = (c != 32).astype(np.uint8)
    around = letter[:-2] + letter[2:]
    at = np.flatnonzero((around + letter[1:-1] >= 2) | ((around == 0) & (letter[1:-1] == 1)))
    code = c[at] * np.uint32(65536) + c[at + 1] * np.uint32(256) + c[at + 2]
    bucket = ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)).astype(np.int64)
    return bucket, np.searchsorted(offs + 2 * np.arange(len(offs)), at, side="right") - 1


def fit_models(df: DataFrame, text: str, label: str, fit_rows: int = 600) -> tuple[list[str], np.ndarray]:
    """Languages with at least 5 labelled rows (the ``MAX_LANGS`` most common)
    and their log trigram probabilities, from about ``fit_rows`` distinct texts
    each."""
    labelled = bounded_batches(df).where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"))
    texts = labelled.groupBy("label", F.xxhash64("text").alias("h")).count()
    counts = texts.groupBy("label").agg(F.sum("count").alias("count"), F.count(F.lit(1)).alias("texts")).orderBy(F.desc("count"), "label").limit(MAX_LANGS).collect()
    top = max((r["count"] for r in counts), default=0)
    share = {r["label"]: fit_rows / r["texts"] for r in counts if r["count"] >= min(5, top)}
    langs = sorted(share)
    if not langs:
        return [], np.empty((0, BUCKETS), np.float32)
    limit = F.lit(0.0)
    for k, v in share.items():
        limit = F.when(F.col("label") == k, F.lit(min(1.0, v) * 2.0**62)).otherwise(limit)
    chosen = labelled.withColumn("h", F.xxhash64("text")).where(F.abs(F.shiftright("h", 1)) <= limit).dropDuplicates(["label", "h"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BUCKETS), np.int64)
        for b in batches:
            which = np.array([langs.index(x) for x in b.column("label").to_pylist()])
            for lo, hi, buf, offs in slices(b.column("text")):
                g, row = trigrams(buf, offs)
                np.add.at(total, (which[lo:hi][row], g), 1)
        i, g = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(g), pa.array(total[i, g])], ["i", "g", "n"])

    table = np.full((len(langs), BUCKETS), 0.5)
    for r in chosen.mapInArrow(grams, "i long, g long, n long").groupBy("i", "g").agg(F.sum("n").alias("n")).collect():
        table[r["i"], r["g"]] += r["n"]
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def text_posteriors(df: DataFrame, text: str, models: np.ndarray, saturation: int = 40) -> DataFrame:
    """Adds ``__grams`` (trigrams of the whole text) and ``__post`` (posterior
    from the text alone, uniform prior).  A mean log likelihood counts as much
    as ``saturation`` trigrams at most: longer texts are not independent
    evidence without end, and other evidence must still be able to speak."""
    from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType
    n_langs = len(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, out = np.zeros(b.num_rows, np.int64), np.full((b.num_rows, n_langs), 1.0 / max(1, n_langs))
            for lo, hi, buf, offs in slices(b.column(text)):
                g, row = trigrams(buf, offs)
                n[lo:hi] = np.bincount(row, minlength=hi - lo)
                ll = np.stack([np.bincount(row, weights=m[g], minlength=hi - lo) for m in models], axis=1).astype(np.float64)
                ll *= (np.minimum(n[lo:hi], saturation) / np.maximum(n[lo:hi], 1))[:, None]
                e = np.exp(ll - ll.max(axis=1, keepdims=True))
                out[lo:hi] = e / e.sum(axis=1, keepdims=True)
            post = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * n_langs, pa.int32()), pa.array(out.ravel()))
            rest = [c for c in b.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(n), post], [*rest, "__grams", "__post"])

    schema = StructType([f for f in df.schema if f.name != text]).add("__grams", LongType()).add("__post", ArrayType(DoubleType()))
    return df.mapInArrow(score, schema)


def identify(df: DataFrame, text: str = "text", declared: str | Column = "lang", host: str | Column = "source",
             suffix: str | Column | None = None, label: str | None = "lang", keep: tuple[str, ...] = ("doc_id",),
             fit_rows: int = 600, kappa: float = 20.0, least_posterior: float = 0.5) -> DataFrame:
    """``keep`` columns, ``lang``, ``posterior``, ``n_grams``, ``rejected`` of
    every row.

    ``declared``: what the markup says; ``host`` and ``suffix`` (by default the
    host's last dotted part): where it came from; ``label``: labelled rows to
    fit on.  ``kappa``: rows' worth of weight of the level above in a prior.
    """
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    host_col = F.coalesce(as_col(host).cast("string"), F.lit(""))
    langs, models = fit_models(df, text, label or declared, fit_rows)
    rows = df.select(*keep, F.col(text).alias("__text"), F.coalesce(as_col(declared).cast("string"), F.lit("")).alias("__said"),
                     host_col.alias("__host"))
    if not langs:
        return rows.select(*keep, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("posterior"),
                           F.lit(0).cast("long").alias("n_grams"), F.lit(True).alias("rejected"))
    scored = cut_lineage(text_posteriors(rows, "__text", models), "language")
    n = range(len(langs))
    total = lambda: [F.sum(F.when(F.col("__grams") > 0, F.col(f"c{i}"))).alias(f"c{i}") for i in n]
    # a row's vote: its text posterior, and what it declares at a fixed trust
    other = (1 - TRUST) / max(1, len(langs) - 1)
    trust = [F.when(F.col("__said") == x, TRUST).when(F.col("__said").isin(langs), other).otherwise(1.0) for x in langs]
    whole = sum((F.col("__post")[i] * trust[i] for i in n), F.lit(0.0))
    votes = scored.select("__host", "__said", "__grams", *[(F.col("__post")[i] * trust[i] / whole).alias(f"c{i}") for i in n])
    pairs = cut_lineage(votes.groupBy("__host", "__said").agg(*total()).na.fill(0.0, [f"c{i}" for i in n]), "evidence")
    row_sum = lambda p: sum((F.col(f"{p}{i}") for i in n), F.lit(0.0))
    sums = lambda p: [F.sum(f"c{i}").alias(f"{p}{i}") for i in n]
    world = pairs.agg(*sums("w")).first()
    base = [((world[f"w{i}"] or 0.0) + 1.0) for i in n]
    base = [x / sum(base) for x in base]
    suffix_of = as_col(suffix) if suffix is not None else F.substring_index("__host", ".", -1)
    hosts = pairs.groupBy("__host").agg(*sums("h")).withColumn("__suffix", suffix_of)
    suffixes = hosts.groupBy("__suffix").agg(*[F.sum(f"h{i}").alias(f"s{i}") for i in n])
    prior = hosts.join(suffixes, "__suffix").select("__host", *[
        ((F.col(f"h{i}") + kappa * (F.col(f"s{i}") + kappa * base[i]) / (row_sum("s") + kappa)) / (row_sum("h") + kappa)).alias(f"p{i}") for i in n])
    # P(declared | language): smoothed over the declared values that occur
    said = pairs.groupBy("__said").agg(*sums("d"))
    n_said = pairs.select(F.approx_count_distinct("__said")).first()[0] + 1
    said = said.select("__said", *[(F.when(F.col("__said") == "", 1.0).otherwise(
        (F.col(f"d{i}") + 1.0) / ((world[f"w{i}"] or 0.0) + n_said))).alias(f"q{i}") for i in n])
    evidence = pairs.select("__host", "__said").join(prior, "__host").join(said, "__said").select(
        "__host", "__said", F.array(*[F.col(f"p{i}") * F.col(f"q{i}") for i in n]).alias("__e"))
    fused = scored.join(small_side(evidence), ["__host", "__said"]).withColumn("__f", F.zip_with("__post", "__e", lambda a, b: a * b))
    fused = fused.withColumn("__m", F.array_max("__f")).withColumn("posterior", F.when(F.col("__grams") > 0, F.col("__m") / F.aggregate("__f", F.lit(0.0), lambda a, x: a + x)).otherwise(0.0))
    lang = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("__f", F.col("__m")).cast("int"))
    return fused.select(*keep, F.when(F.col("__grams") > 0, lang).alias("lang"), F.round("posterior", 6).alias("posterior"),
                        F.col("__grams").alias("n_grams"), ((F.col("__grams") == 0) | (F.col("posterior") < least_posterior)).alias("rejected"))


def drop_unidentified(docs: DataFrame, **kwargs) -> DataFrame:
    """``docs`` without the rows that :func:`identify` rejects; all columns."""
    keyed = docs.withColumn("__key", row_key(docs))
    out = identify(keyed, keep=("__key",), **kwargs).where("rejected").select(F.col("__key").alias("__k")).distinct()
    return keyed.join(small_side(out), F.col("__key") == F.col("__k"), "left_anti").select(*docs.columns)
