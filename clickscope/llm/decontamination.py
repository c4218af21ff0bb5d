"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Texts become lower-case words of letters and digits.  A seed is the hash of the
words that a fixed mask selects from ``SPAN`` words; the masks leave different
positions out, so a substituted word spoils only the seeds that select it.  Test
and training seeds are joined; a hit fixes the offset of an item in a document,
at which the words around it are compared: an item leaks if within some
``window`` of its words (the whole item if shorter) at least ``matches`` share
of them equal the document's at that offset.  Whatever differences the default
share allows, a seed is left: the first two masks cover any two of 12 or more
words, the others join them where there are items of 7 to 11 words.  Items under
``SPAN`` words have one seed of all their words and leak verbatim only.

Defined cases: a null or empty text has no words and no hit; items under
``least_words`` words say nothing of their own and are matched by nothing; equal
texts, repeated rows and rows with
null ids are each judged by their own text; an empty table on either side gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.tables import small_side
from clickscope.session import cut_lineage

SPAN = 7
#: Word positions that each mask selects (fixed values).  All but the first
#: ``ALWAYS`` are used for items under ``LONG`` words only.
MASKS = ((0, 1, 2, 3, 6), (0, 2, 4, 5, 6), (1, 3, 4, 5), (0, 2, 5, 6))
ALWAYS, LONG = 2, 12
SEED_ROWS = 2_000_000


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def masks_for(lengths: set[int]) -> dict[int, tuple[int, ...]]:
    """Masks that items of these numbers of words need, by their number."""
    spaced = {i: m for i, m in enumerate(MASKS) if any(n >= SPAN if i < ALWAYS else SPAN <= n < LONG for n in lengths)}
    return spaced | {len(MASKS) + n: tuple(range(n)) for n in sorted(lengths) if n < SPAN}


def seeds(df: DataFrame, w: str, masks: dict[int, tuple[int, ...]], *keep: str, fits: Column | None = None) -> DataFrame:
    """``keep``, position ``pos`` and ``seed`` for every position and mask
    ``i`` that lies inside the text (``fits``: and passes this condition on
    the column ``i``)."""
    n = F.size(w)
    span = {i: SPAN if i < len(MASKS) else len(m) for i, m in masks.items()}
    zipped = F.arrays_zip(*[F.slice(w, o + 1, F.greatest(n - o, F.lit(0))).alias(f"o{o}") if o else F.col(w).alias("o0") for o in range(max(span.values(), default=1))])
    least = min(span.values(), default=SPAN)
    long = df.where(n >= least).select(*keep, F.posexplode(zipped).alias("pos", "z")).where(F.col(f"z.o{least - 1}").isNotNull())
    hashes = [F.when(F.col(f"z.o{span[i] - 1}").isNotNull(), F.struct(F.lit(i).alias("i"), F.xxhash64(F.lit(i), *[F.col(f"z.o{o}") for o in m]).alias("seed"))) for i, m in masks.items()]
    every = long.select(*keep, "pos", F.explode(F.array(*hashes)).alias("h")).where("h is not null").select(*keep, "pos", "h.i", "h.seed")
    return (every if fits is None else every.where(fits)).drop("i")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
          item_text: str = "text", window: int = 13, matches: float = 0.8, least_words: int = 3, seed_rows: int = SEED_ROWS) -> DataFrame:
    """``id_col, item_id, doc_word`` (where the item's first word falls, maybe
    below 0), ``n_item_words, n_matching`` (at that offset) and the
    ``text_key`` of each document that holds (part of) an item: per document
    and item the offset with the most matches."""
    given = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text)).alias("iw")).where((F.size("iw") >= least_words) & (F.col("iw")[0] != ""))
    items = cut_lineage(given.withColumn("item_key", F.xxhash64("iw")).withColumn("n", F.size("iw")), "items")
    # at most LONG numbers reach the driver
    masks = masks_for({r["n"] for r in items.select(F.least("n", F.lit(LONG)).alias("n")).distinct().collect()})
    i, n, spaced = F.col("i"), F.col("n"), len(MASKS)
    fits = F.when(i < ALWAYS, n >= SPAN).when(i < spaced, (n >= SPAN) & (n < LONG)).otherwise(i == n + spaced)
    if not masks:
        masks = {0: MASKS[0]}                       # no item: nothing will be found
    test = small_side(seeds(items, "iw", masks, "item_id", "item_key", "n", fits=fits).drop("n").withColumnRenamed("pos", "ipos"), seed_rows)
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    train = seeds(src.select("id", "key", words(F.col("text")).alias("w")), "w", masks, "id", "key")
    hits = train.join(test, "seed").select("id", "key", "item_id", "item_key", (F.col("pos") - F.col("ipos")).alias("at")).distinct()
    sizes = items.select("item_id", "item_key", "n")
    where = hits.join(small_side(sizes).select(F.col("item_id").alias("i"), F.col("item_key").alias("k"), "n"), F.expr("item_key = k and item_id <=> i"))
    per_doc = cut_lineage(where.groupBy("id", "key").agg(F.collect_set(F.struct("item_id", "item_key", "at", "n")).alias("at")), "hits")
    found = small_side(per_doc.select(F.col("id").alias("hid"), F.col("key").alias("hkey"), "at"))
    text_of = src.join(found, F.expr("key = hkey and id <=> hid")).select("id", "key", words(F.col("text")).alias("w"), "at")
    cut = F.transform("at", lambda c: F.struct(c["item_id"].alias("item_id"), c["item_key"].alias("item_key"), c["at"].alias("at"),
                                               F.slice("w", F.greatest(c["at"], F.lit(0)) + 1, c["n"] + F.least(c["at"], F.lit(0))).alias("dw")))
    pairs = text_of.select("id", "key", F.explode(cut).alias("c")).select("id", "key", "c.*")
    with_item = pairs.join(small_side(items).select(F.col("item_id").alias("i"), F.col("item_key").alias("k"), "iw"), F.expr("item_key = k and item_id <=> i"))
    skip = F.greatest(-F.col("at"), F.lit(0))
    equal = F.zip_with(F.slice("iw", skip + 1, F.size("iw")), "dw", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    full = F.least(F.lit(window), F.size("iw"))
    judged = with_item.withColumn("eq", equal).withColumn("full", full).withColumn("need", F.when(F.size("iw") < SPAN, F.col("full")).otherwise(F.ceil(F.col("full") * F.lit(matches)).cast("int")))
    total = lambda x: F.aggregate(x, F.lit(0), lambda s, v: s + v)
    leak = judged.where(total("eq") >= F.col("need")).where(
        F.exists(F.sequence(F.lit(0), F.greatest(F.size("eq") - F.col("full"), F.lit(0))), lambda i: total(F.slice("eq", i + 1, F.col("full"))) >= F.col("need")))
    best = leak.select("id", "key", "item_id", F.struct(total("eq").alias("n_matching"), (-F.col("at")).alias("back"), F.size("iw").alias("n")).alias("b"))
    return best.groupBy("id", "key", "item_id").agg(F.max("b").alias("b")).select(
        F.col("id").alias(id_col), "item_id", (-F.col("b.back")).cast("long").alias("doc_word"), F.col("b.n").cast("long").alias("n_item_words"),
        F.col("b.n_matching").cast("long").alias("n_matching"), F.col("key").alias("text_key"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **kwargs) -> DataFrame:
    """``docs`` without the documents that hold benchmark passages; all columns."""
    gone = small_side(leaks(docs, benchmark, id_col, text, **kwargs).select(F.col(id_col).alias("__id"), F.col("text_key").alias("__key")).distinct())
    keyed = docs.withColumn("__k", F.xxhash64(text))
    return keyed.join(gone, (keyed["__k"] == gone["__key"]) & keyed[id_col].eqNullSafe(gone["__id"]), "left_anti").select(*docs.columns)
