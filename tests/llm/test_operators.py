"""Training-data operators against plain versions, and the cases their
docstrings define: nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with clashing names."""

import collections
import hashlib
import html as H
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickscope.llm import (chat_formatting, decontamination, html_extraction, jaccard_join, language_id, ordered, quality_rules,
                            queries, sentencepiece_codec, sharding, substring_dedup, tables, textops, token_output)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, key int, s int, part string, n int, words string, host string"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("w%d" % r.randrange(vocabulary) for _ in range(n))


def edge_rows():
    long = prose(1, 30_000, 5000)
    near = prose(2, 200).split()
    near[100] = "changed"
    texts = [None, "", "  \n\t ", "one", "two words", "one two three four five", "A b\nA b\nc", prose(2, 200), " ".join(near), prose(2, 200), long,
             "x" * 5000, "É è ñ 日本 😀\x00 ▁ a▁b", "12 34 56 #*$ |||| !!! ???", prose(3, 80) + "\n" + prose(2, 120), None, "<|endoftext|> it's 9"]
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "src0"][i % 2], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[7], (None, prose(2, 200), "en", "src0", 1), (None, None, None, None, None)]
    return [(*r, "x", 1, 2, "p", 3, "w", "h") for r in rows]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def path(name):
    return queries.tokenizer_file(name)


# --- 1 sharding

def test_sharding(spark, edge, empty, docs):
    for df in (edge, docs):
        got = sharding.assign(df, 7).collect()
        want = sorted(((r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 16) for r in df.collect()),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        total, start, slots = sum(w[2] for w in want), 0, collections.Counter()
        exp = collections.Counter()
        for i, c, n in want:
            shard = start * 7 // total
            exp[(i, c, n, shard, slots[shard])] += 1
            slots[shard] += 1
            start += n
        assert collections.Counter((r["doc_id"], r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in got) == exp
    assert sharding.assign(empty, 7).count() == 0


def test_parts_are_monotone(spark):
    rows = [(None if i % 5 == 0 else (7 if i % 3 == 0 else i), (i * 37 % 101) / 101) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, u double")
    got = df.select("i", "u", ordered.part_of(F.col("i"), [7, 100, 250, 400], F.col("u")).alias("p")).collect()
    order = sorted(got, key=lambda r: (r["i"] is not None, r["i"] or 0, r["u"]))
    assert [r["p"] for r in order] == sorted(r["p"] for r in got)
    assert len({r["p"] for r in got if r["i"] == 7}) > 20


# --- 2 n-gram Jaccard join

def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (x, (i, a)), (y, (j, b)) in itertools.combinations(enumerate(sets), 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
            up[find(x)] = find(y)
    low = {}
    for x, (i, a) in enumerate(sets):
        if i is not None:
            low[find(x)] = min(i, low.get(find(x), i))
    return collections.Counter((i, len(a), low[find(x)] if i is not None else None) for x, (i, a) in enumerate(sets))


def near_copies(n, seed):
    """A group of near copies, chains of edits, and a very common passage."""
    r = random.Random(seed)
    base, common, out = prose(seed, 60).split(), prose(99, 30), []
    for i in range(n):
        t = list(base)
        for _ in range(r.randrange(4)):
            t[r.randrange(len(t))] = "e%d" % r.randrange(50)
        if i % 4 == 0:
            base = t
        out.append(" ".join(t) + (" " + common if i % 3 else ""))
    return out


def test_jaccard_matches_brute_force(spark, edge, empty):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = jaccard_join.components(edge)
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_components(rows)
    rows = [(i, t) for i, t in enumerate(near_copies(90, 5) + near_copies(60, 6) + [prose(k, 40) + " " + prose(99, 30) for k in range(100, 140)])]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for tokens in (4_000_000, 600):                # whole blocks, and blocks in pieces
        got = jaccard_join.components(df, block_tokens=tokens)
        assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_components(rows)
    assert jaccard_join.components(empty).count() == 0


def test_jaccard_pieces_of_overlapping_sets(spark):
    """Blocks of many sets that share half their shingles: pieces of few sets
    give the same components as one."""
    common = prose(600, 30, 10**6)
    rows = [(i, common + " " + prose(700 + (i - i % 2 if i % 10 < 2 else i), 22, 10**6)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(df).collect()}
    cut = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(df, block_sets=7).collect()}
    assert one == cut and one[1] == 0 and one[2] == 2 and len(set(one.values())) == 54


def test_keep_one(edge, empty):
    kept = jaccard_join.keep_one(edge)
    assert kept.columns == edge.columns
    ids = collections.Counter(r["doc_id"] for r in kept.collect())
    # 8 (near), 9 (equal) and the repeated row of 7 go; rows without words or id stay
    assert ids == collections.Counter([*(i for i in range(17) if i not in (8, 9)), None, None])
    assert jaccard_join.keep_one(empty).count() == 0


def test_keep_one_of_unlinked_texts_under_one_id(spark):
    a, b = prose(80, 60, 100_000), prose(81, 60, 100_000)
    rows = [(5, a), (5, b), (5, b), (7, b), (8, a), (9, prose(82, 60, 100_000))]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(5, a), (5, b), rows[5]])


# --- 3 token output

def test_token_output_round_trip(spark, edge, empty, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    one = edge.dropDuplicates(["doc_id"])
    token_output.write(one, f"{tmp_path}/a", path("word_bpe_49k.json"), 2)
    rows = sorted(one.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    start, exp = 0, {}
    for r in rows:
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        exp[r["doc_id"]] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_output.summary(spark, f"{tmp_path}/a").collect()}
    assert got == exp
    single = token_output.read(spark, f"{tmp_path}/a", F.col("id") == 5).collect()
    assert len(single) == 1 and zlib.crc32(bytes(single[0]["tokens"])) == exp[5][2]
    token_output.write(empty, f"{tmp_path}/b", path("word_bpe_49k.json"), 2)
    assert token_output.summary(spark, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("table, step", [(160_000, 1_000_000), (60, 200)])
def test_word_table_equals_the_library(monkeypatch, table, step):
    monkeypatch.setattr(token_output, "TABLE_PARTS", table)
    monkeypatch.setattr(token_output, "STEP_BYTES", step)
    enc = token_output.WordEncoder(path("word_bpe_49k.json"))
    r = random.Random(4)
    parts = ["'s", "'", "S", "a", "B", "é", "É", "1", ".", "!", " ", "\n", "\t", "\xa0", "\x85", "²", "ß", "Σ", "×", "<|", "endoftext", "|>", "日", "́", "\x0b", "\x1d"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(1500)]
    texts += ["", "   ", " \n ", prose(9, 3000)]
    found = list(enc.encode(pa.array([*texts, None])))
    assert len(found) == len(texts) + 1 and found[-1] == b""
    for t, got in zip(texts, found):
        assert np.frombuffer(got, "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids, repr(t)


# --- 4 quality rules

def base_measures(t):
    t = t or ""
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count, covered = collections.Counter(windows), set()
    for i, g in enumerate(windows):
        if count[g] > 1:
            covered.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_quality_measures(spark, edge, empty, docs):
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (None, 1, 0), (99, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    extra = spark.createDataFrame([(1000, "a b c d e f g h a b c d e f g h x\n\na b\na b\r\n", "en")], "doc_id long, text string, lang string")
    for df in (edge, docs, extra):
        got = quality_rules.judge(df, labels).collect()
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert collections.Counter((r["doc_id"], *(r[c] for c in names)) for r in got) == collections.Counter(
            (r["doc_id"], *base_measures(r["text"])) for r in df.collect())
        assert all(r["kept"] != r["base_failed"] for r in got)     # five labels prove no cutoff
    assert quality_rules.judge(empty, labels).count() == 0


def test_cutoffs_are_proven():
    from math import comb
    for n, k, p in ((10, 3, 0.2), (50, 0, 0.01), (200, 5, 0.05)):
        assert abs(quality_rules.binomial_tail(n, k, p) - sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))) < 1e-9
    r, alpha, level, bad = np.random.default_rng(3), 0.05, 0.1, 0
    grid = np.array([0.96**i for i in range(96)])
    for _ in range(300):                           # values in [0, 1): the cutoff c rejects 1 - c of them
        x = r.random(400)
        i = quality_rules.cutoff([(x > g).sum() for g in grid], 400, alpha, level)
        bad += i >= 0 and 1 - grid[i] > alpha
    assert bad <= 300 * level


def test_quality_rejects_symbol_spam(spark):
    r = random.Random(8)
    rows = [(i, " ".join("word%d" % r.randrange(900) for _ in range(60)), "en", 1) for i in range(6000)]
    rows += [(10_000 + i, " ".join("word%d ###" % r.randrange(900) for _ in range(60)), "en", 0) for i in range(50)]
    df = spark.createDataFrame([x[:3] for x in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(x[0], x[3], 0) for x in rows], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(df, labels).collect()
    assert not any(g["kept"] for g in got if g["doc_id"] >= 10_000)
    assert sum(not g["kept"] for g in got if g["doc_id"] < 10_000) <= 60


def test_quality_proves_cutoffs_from_few_rows(spark):
    """700 good rows prove cutoffs for a stratum; one of 40 takes the pool's."""
    r = random.Random(18)
    rows = [(i, " ".join("word%d" % r.randrange(900) for _ in range(60)), "en" if i < 700 else "xx", 1) for i in range(740)]
    rows += [(10_000 + i, " ".join("word%d ###" % r.randrange(900) for _ in range(60)), "en" if i % 2 else "xx", 0) for i in range(20)]
    df = spark.createDataFrame([x[:3] for x in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(x[0], x[3], 0) for x in rows], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(df, labels).collect()
    assert not any(g["kept"] for g in got if g["doc_id"] >= 10_000)
    assert sum(not g["kept"] for g in got if g["doc_id"] < 10_000) <= 7


# --- 5 substring dedup

def test_repeated_passages(spark, edge, empty):
    r = random.Random(9)
    passage = prose(50, 70, 100_000).split()
    fuzzy = list(passage)
    fuzzy[20] = "other"
    del fuzzy[45]
    rows = [(1, prose(51, 100, 100_000) + " " + " ".join(passage) + " " + prose(52, 90, 100_000)),
            (2, prose(53, 40, 100_000) + "\n" + " ".join(passage) + "\n" + prose(54, 20, 100_000)),
            (3, " ".join(fuzzy) + " " + prose(55, 60, 100_000)), (4, prose(56, 300, 100_000)), (5, " ".join(passage[:40]) + " " + prose(57, 50, 100_000))]
    rows += [(10 + i, " ".join("n%d" % r.randrange(10**6) for _ in range(30)) + " " + " ".join(passage)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.passages(df).collect()
    assert {g["doc_id"] for g in got} == {2, 3, *range(10, 50)}
    by = {g["doc_id"]: g for g in got if g["other_id"] == 1}
    assert (by[2]["start_word"], by[2]["end_word"], by[2]["n_matching"]) == (40, 110, 70)
    assert by[3]["start_word"] == 0 and by[3]["end_word"] in (68, 69, 70) and by[3]["n_matching"] >= 67
    left = {x["doc_id"]: x["text"] for x in substring_dedup.remove_passages(df, length=None).collect()}
    assert left[1] == rows[0][1] and left[4] == rows[3][1] and left[5] == rows[4][1]
    assert left[2].split() == prose(53, 40, 100_000).split() + prose(54, 20, 100_000).split()
    assert left[12].split() == rows[7][1].split()[:30]
    cut = substring_dedup.remove_passages(edge)
    assert cut.columns == edge.columns and {x["doc_id"] for x in cut.collect()} == {i for i in range(17) if i not in (8, 9)} | {None}
    assert substring_dedup.passages(empty).count() == 0 and substring_dedup.remove_passages(empty).count() == 0


def test_repeats_whose_parts_stand_elsewhere(spark):
    """X + Y repeats in two documents; X alone and Y alone, each too short to
    count, stand in many documents with smaller ids."""
    x, y = prose(60, 40, 100_000), prose(61, 40, 100_000)
    rows = [(i, f"{prose(1000 + i, 30, 100_000)} {x if i % 2 else y} {prose(2000 + i, 30, 100_000)}") for i in range(1, 61)]
    rows += [(i, f"{prose(3000 + i, 30, 100_000)} {x} {y} {prose(4000 + i, 30, 100_000)}") for i in (100, 101, 102)]
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(g["doc_id"], g["start_word"], g["end_word"], g["other_id"], g["n_matching"]) for g in got} >= {(i, 30, 110, 100, 80) for i in (101, 102)}
    assert {g["doc_id"] for g in got} == {101, 102}


def test_fuzzy_repeats_whose_parts_stand_elsewhere(spark):
    """Passages of 80 words with every 10th word substituted; each half alone,
    too short to count, stands in 20 documents with smaller ids."""
    rows, want = [], []
    for c in range(8):
        x, y = prose(9100 + c, 40, 10**6), prose(9200 + c, 40, 10**6)
        rows += [(1000 * c + i, f"{prose(50_000 + 100 * c + i, 30, 10**6)} {x if i % 2 else y} {prose(60_000 + 100 * c + i, 30, 10**6)}") for i in range(40)]
        q = ["s%d.%d" % (c, i) if i % 10 == 9 else w for i, w in enumerate(f"{x} {y}".split())]
        rows += [(1000 * c + 100, f"{prose(70_000 + c, 30, 10**6)} {x} {y} {prose(71_000 + c, 30, 10**6)}"),
                 (1000 * c + 101, f"{prose(72_000 + c, 30, 10**6)} {' '.join(q)} {prose(73_000 + c, 30, 10**6)}")]
        want.append((1000 * c + 101, 1000 * c + 100))
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(g["doc_id"], g["other_id"]): g["end_word"] - g["start_word"] for g in got}
    assert set(found) <= set(want) and sum(found.get(w, 0) >= 72 for w in want) >= 7, found


def test_occurrences_leave_by_partner():
    """One row for each document and pair of meeting points holds all their occurrences."""
    r = np.random.default_rng(3)
    doc, pos = np.repeat(np.arange(50), 30), np.tile(np.arange(30), 50)
    first, pick = np.zeros(1500, np.int64), np.repeat(r.integers(0, 50, 50), 30)
    t = substring_dedup.by_partner(doc, pos, first, pos, pick, pos).to_pylist()
    assert all(x["pos"] == x["first_pos"] == x["pick_pos"] == list(range(30)) for x in t)
    assert [(x["doc"], x["first"], x["pick"]) for x in t] == [(i, 0, pick[30 * i]) for i in range(50)]
    none = np.empty(0, np.int64)
    assert substring_dedup.by_partner(none, none, none, none, none, none).num_rows == 0


def test_meetings_are_one_row_a_document(spark):
    """Documents that share a seed or two with many others each: what leaves a
    range of seeds is a row a part, and what is joined a row a document."""
    phrases = [prose(80_000 + i, 12, 10**6) for i in range(400)]
    rows = [(i, " ".join(f"{phrases[(i * 7 + 31 * j) % 400]} {prose(90_000 + 20 * i + j, 9, 10**6)}" for j in range(8))) for i in range(120)]
    rows += [(1000 + i, f"{prose(95_000 + i, 30, 10**6)} {phrases[0]} {phrases[1]}") for i in range(40)]
    src = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "text", "xxhash64(text) as key")
    met = substring_dedup.meetings(src, 20_000).collect()
    got = {r["doc"]: r for r in met}
    seeds = substring_dedup._seeds(src).collect()
    docs = collections.defaultdict(set)
    for r in seeds:
        docs[r["g"]].add(r["doc"])
    want = collections.defaultdict(list)
    for r in sorted(seeds, key=lambda r: r["pos"]):
        if len(docs[r["g"]]) > 1:
            want[r["doc"]].append((r["pos"], min(docs[r["g"]])))
    assert len(met) == len(got) and {d: list(zip(r["pos"], r["first"])) for d, r in got.items()} == dict(want)
    assert all(len(r["pos"]) == len(r["pick"]) == len(r["pick_pos"]) == len(r["first_pos"]) and set(r["pick"]) <= set(got) for r in met)
    key = np.arange(10_000)
    t = substring_dedup.by_part(key, 4, doc=key, pos=key)
    assert t.num_rows == 64 and sorted(t["doc"].combine_chunks().flatten().to_pylist()) == key.tolist() and t["doc"].to_pylist() == t["pos"].to_pylist()
    none = key[:0]
    assert substring_dedup.by_part(none, 4, doc=none).num_rows == substring_dedup.by_document(none, none).num_rows == 0


def test_broadcast_follows_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 1000, [i] * 5, [{"a": i, "b": None}], None) for i in range(20)], "k long, s string, n array<int>, t array<struct<a:long,b:string>>, z array<long>")
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan(tables.small_side(df)) and "strategy=broadcast" not in plan(tables.small_side(df, size=20_000))
    assert tables.small_side(df.limit(0)).count() == 0


def test_exact_repeats_match_brute_force(spark):
    """Texts of few parts of 20 to 60 words: every window of 50 words that an
    earlier document has is in a passage."""
    r = random.Random(77)
    parts = [prose(5000 + i, r.randrange(12, 45), 100_000).split() for i in range(14)]
    texts = [sum((r.choice(parts) for _ in range(7)), []) for _ in range(60)]
    covered, seen, want = collections.defaultdict(set), {}, set()
    for g in substring_dedup.passages(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect():
        covered[g["doc_id"]].update(range(g["start_word"], g["end_word"]))
    for i, t in enumerate(texts):
        windows = [tuple(t[p:p + 50]) for p in range(len(t) - 49)]
        want.update((i, p + o) for p, w in enumerate(windows) if w in seen for o in range(50))
        seen.update((w, i) for w in windows)
    assert want and all(p in covered[i] for i, p in want)


def test_texts_of_one_id_are_documents_of_their_own(spark):
    p, q = prose(90, 80, 100_000), prose(91, 80, 100_000)
    a, b = p + " " + prose(92, 40, 100_000), q + " " + prose(93, 40, 100_000)
    rows = [(5, a), (5, b), (7, prose(94, 20, 100_000) + " " + q), (8, prose(95, 20, 100_000) + " " + p), (5, b), (9, a), (None, p), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(g["doc_id"], g["start_word"], g["end_word"], g["other_id"]) for g in substring_dedup.passages(df).collect()}
    assert got == {(7, 20, 100, 5), (8, 20, 100, 5), (9, 0, 120, 5)}
    left = collections.Counter((r["doc_id"], r["text"]) for r in substring_dedup.remove_passages(df, length=None).collect())
    assert left[(5, a)] == 1 and left[(5, b)] == 2 and {i for i, _ in left} == {5, 7, 8, None, 6}


def test_recall_of_substituted_passages(spark):
    """Passages of 60 and 100 words with every 6th to 12th word substituted
    (83 % equal and more): found over at least 90 % of their words."""
    rows, want, seed = [], [], 0
    for n, every in itertools.product((60, 100), (6, 8, 10, 12)):
        for _ in range(25):
            seed += 1
            p = prose(7000 + seed, n, 10**6).split()
            q = ["s%d.%d" % (seed, i) if i % every == every - 1 else x for i, x in enumerate(p)]
            rows += [(2 * seed, f"{prose(17_000 + seed, 40, 10**6)} {' '.join(p)} {prose(27_000 + seed, 40, 10**6)}"),
                     (2 * seed + 1, f"{prose(37_000 + seed, 30, 10**6)} {' '.join(q)} {prose(47_000 + seed, 30, 10**6)}")]
            want.append((n, every, 2 * seed + 1))
    got = {g["doc_id"]: g["end_word"] - g["start_word"] for g in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    share = {c: sum(got.get(i, 0) >= 0.9 * c[0] for n, e, i in want if (n, e) == c) / 25 for c in {w[:2] for w in want}}
    print(sorted(share.items()))
    assert all(v >= 0.85 for v in share.values()), share


def test_single_segments_are_aligned_as_one_by_one():
    """Many chains of one segment at once give what ``align`` gives for each."""
    r = np.random.default_rng(8)
    bws, aws, at, want = [], [], [], []
    for i in range(600):
        nb, na, n = r.integers(3, 120), r.integers(3, 120), r.integers(1, 40)
        n = min(n, nb, na)
        b0, a0 = r.integers(0, nb - n + 1), r.integers(0, na - n + 1)
        bw, aw = r.integers(0, 3, nb).astype("<u4"), r.integers(0, 3, na).astype("<u4")
        if i % 3:                                  # like words around the segment, some of them changed
            lo, hi = min(b0, a0, r.integers(0, 50)), min(nb - b0, na - a0, n + r.integers(0, 50))
            aw[a0 - lo:a0 + hi] = np.where(r.random(lo + hi) < 0.15, 9, bw[b0 - lo:b0 + hi])
        bws.append(bw), aws.append(aw), at.append((b0, a0, n))
        x = substring_dedup.align(bw, aw, 0, 0, *(np.array([v]) for v in (b0, a0, n)))
        want.append((b0 - x[0], x[1] - b0 - n, x[4], int((bw[b0:b0 + n] == aw[a0:a0 + n]).sum())))
    edge = lambda v: np.append(0, np.cumsum([len(x) for x in v]))
    got = substring_dedup.align_single(np.concatenate(bws), np.concatenate(aws), edge(bws), edge(aws), *np.array(at).T)
    assert list(zip(*(v.tolist() for v in got))) == want and sum(w[0] + w[1] for w in want) > 1000
    none = np.empty(0, np.int64)
    assert all(len(v) == 0 for v in substring_dedup.align_single(none, none, np.zeros(1, np.int64), np.zeros(1, np.int64), none, none, none))


def test_chains_beat_no_order():
    """The Fenwick chaining finds the best chain of a brute-force search."""
    r = random.Random(12)
    for _ in range(40):
        seg = np.array([[r.randrange(60), r.randrange(60), 8, 8.0] for _ in range(7)], float)
        best = -1e9
        for k in range(1, 8):
            for p in itertools.permutations(range(7), k):
                if all(seg[a][0] + 8 <= seg[b][0] and seg[a][1] + 8 <= seg[b][1] for a, b in zip(p, p[1:])):
                    gap = sum(seg[b][0] - seg[a][0] - 8 + seg[b][1] - seg[a][1] - 8 for a, b in zip(p, p[1:]))
                    best = max(best, 8 * k - substring_dedup.GAP * gap)
        path = substring_dedup.chains(seg)[0]
        gap = sum(seg[b][0] - seg[a][0] - 8 + seg[b][1] - seg[a][1] - 8 for a, b in zip(path, path[1:]))
        assert abs(8 * len(path) - substring_dedup.GAP * gap - best) < 1e-9


# --- 6 chat formatting

def plain_maximal(rows):
    conv = collections.defaultdict(set)
    for c, t, role, text in rows:
        if c is not None:
            conv[c].add((t is not None, t or 0, role, text))
    seq = {c: [(r, x) for _, _, r, x in sorted(s, key=lambda e: e[:2])] for c, s in conv.items()}
    return {c for c, s in seq.items() if not any((len(o) > len(s) and o[:len(s)] == s) or (o == s and d < c) for d, o in seq.items())}


def test_chat_maximal_conversations(spark):
    r = random.Random(3)
    rows = []
    for c in range(60):
        base = r.randrange(5)
        for t in range(r.randrange(1, 7)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"{base} {t}" if r.random() < 0.95 else None))
    rows += [(100, t, "user", f"long {t}") for t in range(700)] + [(101, t, "user", f"long {t}") for t in range(600)]
    rows += [rows[0], (None, 0, "user", "nobody"), (102, None, None, "<|im_start|>"), (103, 0, "user", ""), (104, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1)).repartition(4)
    got = chat_formatting.render(df).collect()
    assert {g["conv_id"] for g in got} == plain_maximal(rows)
    long = sorted((g["part"], g["rendered"]) for g in got if g["conv_id"] == 100)
    assert len(long) == 4 and "".join(x for _, x in long) == "".join(f"<|im_start|>user\nlong {t}<|im_end|>\n" for t in range(700))
    assert next(g["rendered"] for g in got if g["conv_id"] == 102) == "<|im_start|>unknown\n< |im_start|><|im_end|>\n"
    assert chat_formatting.render(df.limit(0)).count() == 0


# --- 7 SentencePiece

def test_sentencepiece_round_trip(spark, edge, empty, docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for df in (edge, docs):
        exp = collections.Counter()
        for r in df.collect():
            ids = sp.encode(r["text"] or "", add_eos=True)
            exp[(r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids)))] += 1
        got = sentencepiece_codec.round_trip(df, path("piece_bpe_32k.model"), with_ids=False)
        assert collections.Counter((g["doc_id"], g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) for g in got.collect()) == exp
    assert sentencepiece_codec.round_trip(empty, path("piece_bpe_32k.model")).count() == 0


def test_chunk_table_generations(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "TABLE_CHUNKS", 60)
    monkeypatch.setattr(sentencepiece_codec, "STEP_CHARS", 200)
    table = sentencepiece_codec.ChunkTable(path("piece_bpe_32k.model"))
    r = random.Random(5)
    parts = [" ", " ", "▁", "a", "the", "\n", "\t", "é", "😀", "<", "0", ".", "s>", "</s>", "\x00", "　"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(800)]
    for t, (ids, decoded) in zip(texts, table.encode(texts)):
        want = table.sp.encode(t)
        assert ids == " ".join(map(str, want)) and decoded == table.sp.decode(want + [2]), repr(t)


# --- 8 language ID

def test_language_held_out_accuracy(spark, docs):
    """Fitted on even ids, judged on odd ids with nothing declared."""
    hidden = docs.withColumn("known", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    got = language_id.identify(hidden.withColumnRenamed("lang", "truth"), declared=F.lit(None).cast("string"), label="known", keep=("doc_id", "truth"))
    odd = [r for r in got.collect() if r["doc_id"] % 2]
    assert len(odd) == 100 and sum(r["lang"] == r["truth"] for r in odd) >= 95


def test_language_cases(spark, edge, empty, docs):
    got = {r["doc_id"]: r for r in language_id.identify(docs.select("doc_id", "text", "lang", "source").unionByName(
        edge.select((F.col("doc_id") + 10_000).alias("doc_id"), "text", "lang", "source"))).collect()}
    assert all(not got[r["doc_id"]]["rejected"] for r in docs.collect() if re.search("[a-zA-Z]{3}", r["text"] or ""))
    assert all(got[10_000 + i]["rejected"] and got[10_000 + i]["lang"] is None for i in (0, 1, 2, 15))
    assert language_id.identify(empty).count() == 0 and language_id.drop_unidentified(empty).columns == empty.columns
    kept = language_id.drop_unidentified(edge)
    assert kept.columns == edge.columns and not {0, 1, 2} & {r["doc_id"] for r in kept.collect()}


def test_language_prior_speaks_where_the_text_does_not(spark):
    """Two languages of the same words: the host decides, a new host of a known
    suffix by its suffix."""
    rows = [(i, prose(i, 40), lang, f"h{i % 5}.example.{lang}") for i in range(100) for lang in ("aa", "bb")]
    new = [(900, prose(500, 40), None, "h1.example.aa"), (901, prose(500, 40), None, "h1.example.bb"), (902, prose(501, 40), None, "new.example.bb")]
    df = spark.createDataFrame(rows + new, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["lang"] for r in language_id.identify(df).where("doc_id >= 900").collect()}
    assert got == {900: "aa", 901: "bb", 902: "bb"}


def test_models_are_fitted_on_distinct_texts(spark):
    """A text copied 20,000 times takes one row, not the language's sample."""
    copies = spark.range(20_000).select(F.lit("zz").alias("lang"), F.lit("zzz qqq xxx").alias("text"))
    rest = spark.createDataFrame([("zz", prose(i, 30)) for i in range(300)], "lang string, text string")
    langs, models = language_id.fit_models(copies.unionByName(rest), "text", "lang", fit_rows=60)
    import pyarrow as pa
    (_, _, buf, offs), = textops.slices(pa.array([prose(0, 400), "zzz qqq xxx"]))
    g, row = language_id.trigrams(buf, offs)
    seen = [float(models[0][g[row == i]].mean()) for i in (0, 1)]
    assert langs == ["zz"] and seen[0] > float(models[0].mean()) + 2 and seen[0] > seen[1]


# --- 9 decontamination

def test_masks_leave_a_seed_whatever_differs():
    for n in range(decontamination.SPAN, 20):
        full = min(n, 13)
        masks = decontamination.masks_for({n}).values()
        for bad in itertools.combinations(range(full), full - -(-8 * full // 10)):
            assert any(all(i + o not in bad for o in m) for i in range(full - decontamination.SPAN + 1) for m in masks), (n, bad)
    assert decontamination.masks_for({15, 30}).keys() == {0, 1}


def plain_leaks(docs, items):
    out = set()
    for d, text in docs:
        w = text.split()
        for i, item in items:
            x = item.split()
            full = min(13, len(x))
            need = full if len(x) < 7 else -(-8 * full // 10)
            for at in range(1 - len(x), len(w)):
                eq = [0 <= at + j < len(w) and w[at + j] == v for j, v in enumerate(x)]
                if len(x) > 2 and any(sum(eq[s:s + full]) >= need for s in range(len(x) - full + 1)):
                    out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    r = random.Random(5)
    items = [(i, prose(500 + i, n, 10**6)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 6, 7, 7, 8, 9, 10, 10, 11, 12, 13, 16, 30])]
    docs = []
    for d in range(300):
        x = r.choice(items)[1].split()
        for at in r.sample(range(len(x)), min(len(x), r.choice([0, 0, 1, 1, 2, 2, 3, 4]))):
            x[at] = "z%d" % r.randrange(9)
        cut = r.choice([0, 0, 0, 3])
        docs.append((d, " ".join([prose(900 + d, r.randrange(9), 10**6), *x[cut:], prose(2000 + d, r.randrange(9), 10**6)])))
    docs += [(300 + i, f"a {x} b") for i, x in items]
    want = plain_leaks(docs, items)
    got = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(g["doc_id"], g["item_id"]) for g in got.collect()} == want and len(want) > 100 and {i for _, i in want} >= {2, 3, 4, 5, 7, 11}


def test_leaks(spark, edge, empty):
    item = prose(70, 40, 10**6).split()
    changed = list(item)
    changed[10], changed[17], changed[30] = "p", "q", "r"
    rows = [(1, prose(71, 90, 10**6) + ". " + " ".join(item).upper() + "!"), (2, " ".join(changed) + " " + prose(72, 30, 10**6)), (3, prose(73, 200, 10**6)),
            (4, " ".join(item[:13])), (5, " ".join(item[:10])), (6, "x " * 30 + " ".join(item[20:])), (None, " ".join(item)), (8, None), (9, "")]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (None, prose(74, 30, 10**6)), (1, " ".join(item))], "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(5))
    for limit in (decontamination.SEED_ROWS, 0):   # broadcast seeds, and a shuffled join
        got = {r["doc_id"]: r for r in decontamination.leaks(df, bench, seed_rows=limit).collect()}
        assert set(got) == {1, 2, 4, 6, None}
        assert (got[1]["doc_word"], got[1]["n_matching"], got[2]["n_matching"], got[6]["doc_word"]) == (90, 40, 37, 10)
    assert {r["doc_id"] for r in decontamination.drop_leaks(df, bench).collect()} == {3, 5, 8, 9}
    assert decontamination.leaks(empty, bench).count() == 0 and decontamination.leaks(df, bench.limit(0)).count() == 0
    assert decontamination.drop_leaks(edge, bench).count() == edge.count()


def test_every_planted_item_is_found(spark, sf_dir, docs):
    norm = lambda s: " ".join(re.sub(r"[\W_]+", " ", (s or "").lower()).split())
    items = {r["item_id"]: norm(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, x in items.items() if f" {x} " in f" {norm(r['text'])} "}
    got = queries.op9_decontamination(spark, sf_dir).collect()
    assert want <= {(r["doc_id"], r["item_id"]) for r in got}


# --- 10 HTML extraction

def page(main, notice="", tail=True):
    return ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body class='has-sidebar'><header><h1>Site</h1></header>"
            f"<nav><ul><li><a href='/'>Home</a></ul></nav><!-- <p>x --><div class=ad>Buy</div>{notice}{main}<aside>Side</aside>"
            "<section id='comments'><article class='comment'><p>First!</p></article></section><form><input value=1>Search</form><footer>&copy; x</footer>" + ("</body></html>" if tail else ""))


def test_html_main_text(spark):
    body = "<article><header><h1>A &amp; B</h1></header><p>One <b>bo</b>ld&nbsp;word.<br>two<p>Three &lt;x&gt; <i>f\n our</i></p><div class='share-buttons'>Tweet</div><ul><li>a<li>b</ul></article>"
    want = "A & B One bold word. two Three <x> f our a b"
    rows = [(1, "http://h.example/1", page(body)), (2, None, page(body, tail=False)), (3, "http://h.example/3", None), (4, "x", ""), (5, "http://h.example/5", "plain &eacute; text"),
            (6, "u", "<p>no end <b>here"), (7, "u", page("<div class='content-sidebar-wrap'><main><p>In main</p></main></div>")), (1, "http://h.example/1", page(body))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit("h"))
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_extraction.extract(df).collect())
    exp = [(1, want), (1, want), (2, want), (3, ""), (4, ""), (5, "plain é text"), (6, "no end here"), (7, "In main")]
    assert got == [(i, t, len(t)) for i, t in exp]
    assert html_extraction.extract(df.limit(0)).count() == 0


def test_site_style_tree_removes_what_repeats(spark):
    """Unnamed boilerplate of a host goes, the same markup with own text stays;
    the map and the join give the same result."""
    rows = []
    for i in range(30):
        rows.append((i, f"http://a.example/{i}", f"<body><div class=x1><p>Follow our news</p><p>All rights kept</p></div><div class=x2><p>{prose(i, 30)}</p><p>{prose(i + 50, 20)}</p></div></body>"))
        rows.append((100 + i, f"http://b.example/{i}", f"<body><div class=x1><p>{prose(i + 200, 12)}</p></div></body>"))
    rows += [(200 + i, f"http://c.example/{i}", f"<body><article><p>Same text on every page</p><p>{i}</p></article></body>") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    exp = {i: f"{prose(i, 30)} {prose(i + 50, 20)}" for i in range(30)} | {100 + i: prose(i + 200, 12) for i in range(30)} | {
        200 + i: f"Same text on every page {i}" for i in range(9)}
    for limit in (html_extraction.MAP_ROWS, -1):
        assert {r["page_id"]: r["text"] for r in html_extraction.extract(df, map_rows=limit).collect()} == exp


def test_style_tree_acts_inside_the_main_part(spark):
    """Repeated plain lists and sections of an article go; a page whose whole
    article repeats keeps it."""
    rows = [(i, f"http://d.example/{i}", f"<body><article><section><h4>Notice to all</h4></section><p>{prose(i, 30)}</p><ul><li>Home<li>Contact</ul></article></body>") for i in range(20)]
    rows += [(100 + i, f"http://e.example/{i}", f"<body class=v{i}><article><p>{prose(7, 30)}</p></article></body>") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (html_extraction.MAP_ROWS, -1):
        got = {r["page_id"]: r["text"] for r in html_extraction.extract(df, map_rows=limit).collect()}
        assert got == {i: prose(i, 30) for i in range(20)} | {100 + i: prose(7, 30) for i in range(9)}


def test_recurring_parts_of_an_article_stay(spark):
    """Section headings, table heads and by-lines that every page of a host has
    belong to its articles; a repeated section or list of its own goes."""
    rows, exp = [], {}
    for i in range(20):
        a, b, c = prose(i, 25), prose(i + 40, 25), prose(i + 80, 6)
        rows.append((i, f"http://r.example/{i}", f"<body><article><h1>{c}</h1><div>By the kitchen</div><p>{a}</p><h2>Ingredients</h2><p>{b}</p><h2>Method</h2>"
                     f"<table><tr><th>Year</th><th>Goals</th></tr><tr><td>{1900 + i}</td><td>{i}</td></tr></table><p>{a[::-1]}</p>"
                     f"<section><h4>Follow us</h4><ul><li>Home</li><li>Contact</li></ul></section></article></body>"))
        exp[i] = f"{c} By the kitchen {a} Ingredients {b} Method Year Goals {1900 + i} {i} {a[::-1]}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (html_extraction.MAP_ROWS, -1):
        assert {r["page_id"]: r["text"] for r in html_extraction.extract(df, map_rows=limit).collect()} == exp


def test_very_deep_and_broken_pages_take_linear_time():
    import time
    for unit, close in (("<div>x ", ""), ("<b>x ", "</i>"), ("<article>x ", ""), ("<p><span>x ", "</u>")):
        began = time.time()
        page = html_extraction.Page("<body>" + (unit + close) * 50_000)
        paths = page.paths()
        assert page.text({p: (0.9, 0.9) for p in paths[:50]}).count("x") == 50_000
        assert max(map(len, paths)) <= 24 and time.time() - began < 60
        assert len(page.with_above(e for e, _ in page.blocks)) <= len(page.tag)


def test_pages_equal_a_plain_reading(spark, sf_dir):
    pages = {r["page_id"]: r["html"] or "" for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op10_html_extraction(spark, sf_dir).collect():
        inner = pages[r["page_id"]].partition("<article>")[2].partition("</article>")[0]
        text = H.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner)))
        assert r["text"] == " ".join(text.split()) and r["n_chars"] == len(r["text"])


# --- helpers

def test_word_spans_and_minimizers():
    text = "a  bb\tccc\x0bé x"
    import pyarrow as pa
    (lo, hi, buf, offs), = textops.slices(pa.array([text, None, "", "d e"]))
    w = textops.Words(buf, offs)
    raw = buf.tobytes()
    assert (lo, hi) == (0, 4) and [raw[a:b].decode() for a, b in zip(w.starts, w.ends)] == WORD.findall(text) + ["d", "e"]
    assert w.counts.tolist() == [4, 0, 0, 2]
    shared = prose(5, 15, 10**6)
    texts = pa.array([prose(6, 40, 10**6) + " " + shared + " q", "z " + shared + " " + prose(7, 30, 10**6)])
    (_, _, buf, offs), = textops.slices(texts)
    w = textops.Words(buf, offs)
    g, at = textops.minimizers(w, w.hashes(), 8, 8)
    assert set(g[w.doc[at] == 0]) & set(g[w.doc[at] == 1])


def test_block_of_sets_that_overlap_and_do_not_link():
    """A block's time: 1,200 sets of about 400 tokens, 300 of them common to
    all, next to none linked (92 s by one walk of the trie for each set)."""
    import time

    from clickscope.llm.jaccard_join import trie_components
    rng = np.random.default_rng(5)
    common = np.arange(300)
    lists = [np.concatenate([common[rng.random(300) < 0.85], 300 + rng.choice(20_000, 140, replace=False)]) for _ in range(1200)]
    lists[700] = lists[3][:-10]
    lists[900] = lists[700][:-10]
    began = time.process_time()
    got = trie_components(np.array([len(x) for x in lists]), lists, 75)
    assert time.process_time() - began < 15
    assert got[3] == got[700] == got[900] and len(np.unique(got)) == 1198


def test_trie_components_equal_brute_force():
    from clickscope.llm.jaccard_join import trie_components
    rng = np.random.default_rng(6)
    for trial in range(300):
        order = rng.permutation(1000)[:rng.integers(3, 40)]
        lists = [order[rng.random(len(order)) < rng.choice([0.3, 0.7, 0.95])] for _ in range(rng.integers(1, 14))]
        lists.append(lists[0])
        sizes = np.array([len(x) + int(rng.integers(1, 3)) for x in lists])
        side = None if trial % 2 else rng.random(len(lists)) < 0.5
        want = np.arange(len(lists))
        for i in range(len(lists)):
            for j in range(i):
                both = len(np.intersect1d(lists[i], lists[j]))
                if (side is None or side[i] != side[j]) and 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                    want[want == want[j]] = want[i]
        got = trie_components(sizes, lists, 75, side)
        assert ((got[:, None] == got) == (want[:, None] == want)).all()


def test_chunk_table_looks_up_chunks_alone(monkeypatch):
    """Encoding and decoding start no threads, a step never walks the table,
    and generations that change give the same ids and texts."""
    from clickscope.llm.queries import tokenizer_file

    class Table(dict):
        def __iter__(self):
            raise AssertionError("walked")

        keys = items = values = __iter__

    threads = []
    table = sentencepiece_codec.ChunkTable(tokenizer_file("piece_bpe_32k.model"))
    plain, real = table.sp, table.sp

    class Recorder:
        def encode(self, x, num_threads=None):
            threads.append(num_threads)
            return real.encode(x, num_threads=num_threads)

        def decode(self, x, num_threads=None):
            threads.append(num_threads)
            return real.decode(x, num_threads=num_threads)

    table.sp, table.ids, table.old = Recorder(), Table(), Table()
    texts = ["one two  three\n four", "", "two four five\nsix", "one\n\n two ▁ three", " six  one"] * 3
    want = [(" ".join(map(str, plain.encode(t))), plain.decode(plain.encode(t))) for t in texts]
    assert list(table.encode(texts)) == want and set(threads) == {1}
    monkeypatch.setattr(sentencepiece_codec, "TABLE_CHUNKS", 6)
    monkeypatch.setattr(sentencepiece_codec, "STEP_CHARS", 10)
    table.ids, table.old = {}, {}
    assert list(table.encode(texts)) == want
