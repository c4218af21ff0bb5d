"""Quality rules with risk-controlled cutoffs.

Every text gets its base measures and the values of some rules (a larger value
is worse).  A quarter of the labelled rows of good quality (by hash of the id)
fixes a sequence of cutoff vectors, one cutoff a rule, from loose to strict:
far over all of these rows, down to their largest values, then into their upper
tails by equal shares.  The other rows are the holdout: a vector is safe if the
exact binomial tail rejects "its rules together reject more than ``alpha`` of
the good rows" at level ``delta``.  The test goes along the sequence and stops
at the first vector that fails (fixed-sequence testing: no correction along the
sequence or over the rules); over the strata and their pool the level is divided
(Bonferroni).  So with probability ``1 - delta`` no stratum with its own cutoffs
loses more than ``alpha`` of its good rows to all rules together.  A stratum
with too few good labelled rows for a proof (about 440 in the holdout at 1 % and
four strata) takes the cutoffs proven for all strata pooled, which hold for the
pool on average; without a proof there either only the base rules speak.

Rows meet a fixed grid of candidate cutoffs: grouped counts, two passes over
the labelled rows.

Defined cases: a null or empty text has no words, fails the base rules and is
not kept; a null stratum is a stratum of its own; of several labels of a
document the worst counts, null labels do not; labels without a document are
ignored; repeated rows get equal results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.tables import bounded_batches, small_side
from clickscope.llm.textops import Words, distinct_in_doc, mix, slices
from clickscope.llm.textops import _BYTE, _SPACE, _powers
from clickscope.session import cut_lineage

WINDOW = 8
GRID = 96
#: Rules (larger is worse) and the largest cutoff of their grid; cutoffs fall
#: geometrically by 4 percent a step from there.
RULES = {"symbols_per_word": 4.0, "dup_line_share": 1.0, "repeat_share": 0.3, "upper_share": 1.0, "digit_share": 1.0,
         "marks_per_word": 4.0, "chars_per_word": 64.0, "same_word_share": 1.0}
STEP = 0.96

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = 1
_UPPER, _LETTER, _DIGIT, _MARK = (np.zeros(256, dtype=np.int64) for _ in range(4))
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = 1
_DIGIT[48:58] = 1
_MARK[np.frombuffer(b"!?", np.uint8)] = 1
_POINT = np.ones(256, dtype=np.int64)
_POINT[0x80:0xC0] = 0


def _per_doc(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    run = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=run[1:])
    return run[offs[1:]] - run[offs[:-1]]


def duplicate_lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: lines with a word, and those equal to an earlier one."""
    n_docs, size = len(offs) - 1, len(buf)
    brk = np.flatnonzero(buf == 10)
    starts = np.unique(np.concatenate([offs[:-1], brk + 1]))
    starts = starts[starts < size]
    ends = np.searchsorted(brk, starts)
    ends = np.minimum(np.where(ends < len(brk), brk[np.minimum(ends, len(brk) - 1)] if len(brk) else size, size),
                      offs[np.searchsorted(offs, starts, side="right")])
    run = np.zeros(size + 1, np.int64)
    np.cumsum(~_SPACE[buf], out=run[1:])
    worded = run[ends] > run[starts]
    starts, ends = starts[worded], ends[worded]
    doc = np.searchsorted(offs, starts, side="right") - 1
    p, inv = _powers(size + 1)
    h = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE[buf] * p[:size], out=h[1:])
    h = mix((h[ends] - h[starts]) * inv[starts] + (ends - starts).astype(np.uint64))
    lines = np.bincount(doc, minlength=n_docs)
    return lines, lines - np.bincount(distinct_in_doc(doc, h)[0], minlength=n_docs)


def repeated_words(words: Words, h: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Per document: words inside k-word windows that occur twice or more."""
    g, at = words.grams(h, k)
    if not len(g):
        return np.zeros(words.n_docs, np.int64)
    doc = words.doc[at]
    order = np.lexsort((g, doc))
    d, s = doc[order], g[order]
    same = (d[1:] == d[:-1]) & (s[1:] == s[:-1])
    twice = np.zeros(len(g), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + k + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + k, -1)
    covered = np.cumsum(edge)[:len(h)] > 0
    return np.bincount(words.doc[covered], minlength=words.n_docs)


def measures(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, the base measures and one column per rule."""
    src = bounded_batches(df.select(*keep, F.col(text).alias("__text")))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in slices(b.column("__text")):
                words = Words(buf, offs)
                h = words.hashes()
                n = words.counts.astype(np.int64)
                inside = ~_SPACE[buf]
                chars = _per_doc(_POINT[buf] * inside, offs)
                symbols, letters = _per_doc(_SYMBOL[buf], offs), _per_doc(_LETTER[buf], offs)
                lines, dup = duplicate_lines(buf, offs)
                rep = repeated_words(words, h)
                own = np.bincount(distinct_in_doc(words.doc, h)[0], minlength=words.n_docs)
                per = lambda x, y: x / np.maximum(y, 1)
                # a long text repeats common words: distinct words against the square root law
                expected = np.minimum(n, 8 * np.sqrt(np.maximum(n, 1)))
                rules = [per(symbols, n), per(dup, lines), per(rep, n), per(_per_doc(_UPPER[buf], offs), letters), per(_per_doc(_DIGIT[buf], offs), chars),
                         per(_per_doc(_MARK[buf], offs), n), per(chars, n), 1 - np.minimum(1, per(own, np.maximum(expected, 1)))]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo) for c in keep), *(pa.array(x.astype(np.int64)) for x in (n, chars, symbols, dup, rep)),
                                                  *(pa.array(x.astype(np.float64)) for x in rules)], [*keep, *base, *RULES])

    from pyspark.sql.types import DoubleType, LongType, StructType
    schema = StructType([src.schema[c] for c in keep])
    for c in base:
        schema = schema.add(c, LongType())
    for c in RULES:
        schema = schema.add(c, DoubleType())
    return src.mapInArrow(run, schema)


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exact."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1, dtype=float)
    log_choose = np.concatenate([[0.0], np.cumsum(np.log(n - i[:-1]) - np.log(i[1:]))])
    terms = log_choose + i * math.log(p) + (n - i) * math.log1p(-p)
    top = terms.max()
    return float(min(1.0, math.exp(top) * np.exp(terms - top).sum()))


def cutoff(above: list[int], n: int, alpha: float, level: float) -> int:
    """Index of the strictest proven cutoff (-1: none).  ``above``: good rows
    over each cutoff, from the loosest on."""
    best = -1
    for i, k in enumerate(above):
        if k > alpha * n or binomial_tail(n, int(k), alpha) > level:
            break
        best = i
    return best


def grid(rule: str) -> list[float]:
    return [RULES[rule] * STEP**i for i in range(GRID)]


def sequence(hists: list[np.ndarray], shares: int = 40) -> list[list[int]]:
    """Per rule the grid index of its cutoff (-1: none) at each step.
    ``hists``: learning rows by the first grid cutoff that they lie over."""
    out = []
    for hist in hists:
        above = np.cumsum(hist[:GRID])
        clear = int(np.searchsorted(above, 0, side="right")) - 1
        tail = [int(np.searchsorted(above, 0.0005 * j * hist.sum(), side="right")) - 1 for j in range(1, shares + 1)]
        out.append([max(-1, clear - d) for d in range(GRID, -1, -1)] + tail)
    return out


def fit_cutoffs(rows: DataFrame, stratum: str, row_id: str, alpha: float, delta: float) -> DataFrame:
    """``stratum`` (null: all pooled) and per rule the cutoff (infinity: none)
    from good rows."""
    step = F.lit(math.log(STEP))
    # grid cutoffs that a value lies over: those from this index on
    index = {r: F.when(F.col(r) > 0, F.greatest(F.lit(0), F.floor(F.log(F.col(r) / F.lit(top)) / step + F.lit(1e-9)).cast("int") + 1)).otherwise(GRID) for r, top in RULES.items()}
    at = rows.select(F.explode(F.array(stratum, F.lit(None).cast("string"))).alias("s"), (F.pmod(F.xxhash64(F.lit(4), row_id), F.lit(4)) == 0).alias("learn"),
                     F.array(*[F.least(index[r], F.lit(GRID)) for r in RULES]).alias("at"))
    at = cut_lineage(at, "holdout")
    counts = at.where("learn").select("s", F.posexplode("at").alias("rule", "i")).groupBy("s", "rule", "i").count()
    level = delta / (1 + max(1, rows.select(F.count_distinct(stratum)).first()[0]))

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        hists = [np.bincount(g["i"], weights=g["count"], minlength=GRID + 1) for g in (group[group["rule"] == k] for k in range(len(RULES)))]
        path = sequence(hists)
        # step at which a row of grid index i is rejected first
        first = [np.searchsorted(p, np.arange(GRID + 1)).tolist() for p in path]
        return pd.DataFrame([{"s": group["s"].iloc[0], "path": path, "first": first}])

    paths = cut_lineage(counts.groupBy("s").applyInPandas(learn, "s string, path array<array<int>>, first array<array<int>>"), "paths")
    lookup = small_side(paths.select(F.col("s").alias("p"), "first"))
    step_of = F.array_min(F.zip_with("first", "at", lambda f, i: F.get(f, i)))
    steps = at.where("not learn").join(lookup, F.col("s").eqNullSafe(F.col("p"))).groupBy("s", step_of.alias("step")).count()
    tested = steps.groupBy("s").agg(F.collect_list(F.struct("step", "count")).alias("hist"))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for s, path, hist in zip(frame["s"], frame["path"], frame["hist"]):
                length = len(path[0])
                found = np.bincount([x["step"] for x in hist], weights=[x["count"] for x in hist], minlength=length + 1)
                best = cutoff(np.cumsum(found[:length]).astype(int).tolist(), int(found.sum()), alpha, level)
                cut = [p[best] if best >= 0 else -1 for p in path]
                out.append((s, *(grid(r)[i] if i >= 0 else math.inf for r, i in zip(RULES, cut)), best >= 0))
            yield pd.DataFrame(out, columns=[stratum, *RULES, "proven"])

    both = tested.join(paths.withColumnRenamed("s", "p"), F.col("s").eqNullSafe(F.col("p"))).select("s", "path", "hist")
    return both.mapInPandas(fit, f"{stratum} string, " + ", ".join(f"{r} double" for r in RULES) + ", proven boolean").where("proven").drop("proven")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang",
          alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """``id_col``, base measures, ``base_failed``, ``kept`` and ``failed_rules``."""
    src = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("__stratum"), F.col(text).alias("__t"))
    src = src.withColumn("__key", F.xxhash64("__t"))
    rows = measures(src, "__t", ["__id", "__stratum", "__key"])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = cut_lineage(rows.withColumn("base_failed", failed), "measures")
    good = labels.where("quality is not null").groupBy(F.col(id_col).alias("__id")).agg(F.min("quality").alias("q")).where("q = 1").select("__id")
    # a text proves something once, however many rows repeat it
    held = rows.where("not base_failed").join(good, "__id")
    rest = [c for c in held.columns if c not in ("__id", "__stratum", "__key")]
    held = held.groupBy("__stratum", "__key").agg(F.min(F.struct("__id", *rest)).alias("r")).select("__stratum", "r.*")
    proven = cut_lineage(fit_cutoffs(held, "__stratum", "__id", alpha, delta), "cutoffs")
    pool = proven.where("__stratum is null").first()
    limits = small_side(proven.where("__stratum is not null").select(F.col("__stratum").alias("__s"), *[F.col(r).alias(f"__{r}") for r in RULES]))
    joined = rows.join(limits, rows["__stratum"] == limits["__s"], "left")
    if pool:
        joined = joined.withColumns({f"__{r}": F.coalesce(f"__{r}", F.lit(float(pool[r]))) for r in RULES})
    over = F.filter(F.array(*[F.when(F.col(r) > F.col(f"__{r}"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return joined.select(F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.size(over) == 0)).alias("kept"), over.alias("failed_rules"))
