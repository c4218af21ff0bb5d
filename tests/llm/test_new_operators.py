"""Hard negatives, fill-in-middle and SimHash against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickscope.llm import fill_in_middle, hard_negatives, queries, simhash
from clickscope.llm.textops import Words, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, n long, form string, fp long, rows int, output string, cell int, id string"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("w%d" % r.randrange(vocabulary) for _ in range(n))


def edge_rows():
    near = prose(2, 400).split()
    near[200] = "changed"
    r = random.Random(9)
    mixed = "".join(r.choice("aZ é日😀\n\t\x0b ß\x00") for _ in range(4000))
    texts = [None, "", "  \n\t ", "one", "two words", "One two three", " lead and trail \n", prose(2, 400), " ".join(near), prose(2, 400),
             prose(1, 30_000, 5000), "x" * 70_000 + " y " + "é" * 40_000, mixed, "has <P> in it", "ends <", "S> starts", "<" * 30, "日本語 テキスト 😀 " * 40, None]
    texts += [mixed[i:i + 300] for i in range(0, 3000, 300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[7], (7, prose(3, 50)), (None, prose(2, 400)), (None, None), (-4, prose(5, 20))]
    return [(*r, "en", 1, "x", 2, 3, "o", 4, "i") for r in rows]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- 11 hard negatives

def plain_negatives(rows, every=50, positives=5, negatives=3):
    rows = sorted({(i, y, tuple(int(np.floor(256 * np.float64(x))) for x in v)) for i, v, y in rows
                   if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, y, q in rows:
        if i % every:
            continue
        others = sorted((-dot(q, p), j, z) for j, z, p in rows if j != i)
        same = [(s, j) for s, j, z in others if z == y][:positives]
        for s, j in same:
            hit = [(n, t) for t, n, z in others if z != y and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(i, j, r, n, -s, -t) for r, (n, t) in enumerate(hit, 1)]
    return sorted(out)


def mined(df, **kwargs):
    got = hard_negatives.mine(df, **kwargs)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


VECTORS = "vec_id long, embedding array<float>, label int, key string, id int, q string, g int"


def vectors(n, dims, seed, scale=1.0, labels=4):
    r = np.random.default_rng(seed)
    base = r.normal(size=(3, dims))
    out = []
    for i in range(n):
        v = (base[i % 3] + r.normal(size=dims) * 0.8) * scale
        out.append((i, [float(np.float32(x)) for x in v], int(r.integers(labels))))
    return out


def test_negatives_equal_a_plain_version(spark):
    rows = vectors(400, 8, 1)
    rows += [(1000, [0.5] * 3, 1), (1050, [], 2), (1051, [], 2), (1052, [], 1), (1100, None, 1), (1150, [0.1] * 8, None), (None, [0.1] * 8, 1),
             (1200, [float("nan")] + [0.1] * 7, 1), (1201, [float("inf")] * 8, 1), (1202, [None] * 8, 1), rows[50], rows[51], rows[0]]
    rows += [(2000 + i, rows[50][1], i % 4) for i in range(60)]                       # ties: one vector, many rows
    df = spark.createDataFrame([(i, v, y, "k", 0, "q", 1) for i, v, y in rows], VECTORS).repartition(4)
    want = plain_negatives([(i, v, y) for i, v, y in rows])
    assert len(want) > 50
    assert mined(df) == want
    assert mined(df, anchor_rows=3, block_rows=37) == want                             # many blocks: the same rows
    assert hard_negatives.mine(df.limit(0)).count() == 0
    assert hard_negatives.mine(df.where("vec_id % 50 = 1")).count() == 0


def test_negatives_with_large_components_and_a_lone_label(spark):
    rows = vectors(120, 5, 3, scale=30_000.0, labels=3) + [(150, [1.0] * 5, 77)]
    df = spark.createDataFrame([(i, v, y, "k", 0, "q", 1) for i, v, y in rows], VECTORS)
    assert mined(df) == plain_negatives(rows)
    with pytest.raises(Exception, match="too large"):
        mined(spark.createDataFrame([(i, [3e30], 1, "k", 0, "q", 1) for i in (0, 1)], VECTORS))


def test_products_are_exact():
    r = np.random.default_rng(5)
    for dims, top in ((64, 256), (2500, 256), (7, 2**24), (1, 2**27), (64, 1), (0, 1)):
        a, b = (r.integers(-top, top + 1, (n, dims)).astype(np.int32) for n in (9, 13))
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        assert hard_negatives.exact_product(a, b).tolist() == want
    full = np.full((2, 64), -256, np.int32)
    assert hard_negatives.exact_product(full, -full).tolist() == [[-64 * 65536] * 2] * 2


def test_negatives_on_the_given_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op11_hard_negatives(spark, sf_dir).collect())
    assert got == plain_negatives(rows)


# --- 12 fill in the middle

def plain_fim(i, t, seed=42, unit=UNIT):
    t = t or ""
    units = unit.findall(t)
    d = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h[2] % 100 >= 50:
        return i, len(units), "plain", None, None, None, None, t
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return i, len(units), form, len(p), len(m), len(p.encode()), len(m.encode()), out


@pytest.mark.parametrize("seed", [42, 43, 44])
def test_fill_in_middle(edge, empty, docs, seed):
    for unit, pattern in (("word", UNIT), ("char", re.compile("(?s)."))):
        for df in (edge, docs):
            made = fill_in_middle.transform(df, seed=seed, unit=unit)
            made = made.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form")))
            rows = collections.Counter((r["doc_id"], r["text"]) for r in df.collect())
            want = collections.Counter((plain_fim(*k, seed, pattern), k[1] or "") for k in rows.elements())
            got = collections.Counter((tuple(r)[:8], r["back"]) for r in made.collect())
            assert got == want
            assert {k[0][2] for k in got} == {"plain", "spm", "psm"} or df is edge
        assert fill_in_middle.transform(empty, unit=unit).count() == 0


def test_char_index_goes_both_ways():
    text = "a日b😀éz" * 50 + "plain" * 20 + "ß"
    raw = np.frombuffer(text.encode(), np.uint8)
    index = fill_in_middle.CharIndex(raw)
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:c].encode()) for c in chars])
    assert (index.to_bytes(chars) == cuts).all() and (index.to_chars(cuts) == chars).all()
    assert len(index.at) == sum(ord(c) > 127 for c in text)
    ascii_only = fill_in_middle.CharIndex(np.frombuffer(b"abc def", np.uint8))
    assert len(ascii_only.at) == 0 and ascii_only.to_chars(np.array([3])).tolist() == [3]


# --- 13 simhash

def plain_fingerprint(t, k=3):
    w = WORD.findall((t or "").translate(LOWER))
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_simhash(rows, radius=2):
    fps = [plain_fingerprint(t) for _, t in rows]
    low = {f: f for f in fps}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    known = sorted(low)
    for x, a in enumerate(known):
        for b in known[x + 1:]:
            if (a ^ b).bit_count() <= radius:
                low[find(a)] = find(b)
    first = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            first[find(f)] = min(i, first.get(find(f), i))
    return collections.Counter((i, f"{f:016x}", first.get(find(f))) for (i, _), f in zip(rows, fps))


def test_simhash_equals_a_plain_version(edge, empty, docs):
    for df in (edge, docs):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        got = collections.Counter(tuple(r) for r in simhash.components(df).collect())
        assert got == plain_simhash(rows)
        assert len({c for *_, c in got}) < len({f for _, f, _ in got}) or df is docs
    assert simhash.components(empty).count() == 0


def test_simhash_links_and_chains(spark, monkeypatch):
    """Fingerprints at all distances from 0 to 4 of each other, in chains and
    dense groups, with tiles so small that cells are split."""
    r = random.Random(3)
    fps = set()
    for _ in range(60):
        x = r.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            for _ in range(r.randrange(1, 5)):
                x ^= 1 << r.randrange(64)
    dense = r.getrandbits(64)
    fps |= {dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)} | {0, 1, 2**64 - 1, 2**63}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    low = {f: f for f in fps}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    def join(pairs):
        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            low[y] = x

    known = sorted(fps)
    join((a, b) for i, a in enumerate(known) for b in known[i + 1:] if (a ^ b).bit_count() <= 2)
    want = {f: find(f) for f in fps}
    for rows in (simhash.TILE_ROWS, 5):
        monkeypatch.setattr(simhash, "TILE_ROWS", rows)
        found = [(e["u"] % 2**64, e["v"] % 2**64) for e in simhash.links(df).collect()]
        assert all((a ^ b).bit_count() <= 2 or want[a] == want[b] for a, b in found)
        low.update({f: f for f in fps})
        join(found)
        assert {f: find(f) for f in fps} == want


def test_xxh64_of_every_length():
    r = random.Random(1)
    raw = bytes(r.randrange(256) for _ in range(5000))
    spans = [(i, i + n) for n in range(0, 70) for i in (0, 3, 17, 5000 - n)]
    a, b = np.array(spans).T
    assert simhash.xxh64(np.frombuffer(raw, np.uint8), a, b).tolist() == [xxhash.xxh64_intdigest(raw[x:y], 42) for x, y in spans]
    for _, _, buf, offs in slices(__import__("pyarrow").array(["Ab  c\n", "", "é DD"])):
        text, starts, ends = simhash.joined_words(Words(buf, offs))
        assert [bytes(text[x:y]).decode() for x, y in zip(starts, ends)] == ["ab", "c", "é", "dd"]


def test_heavy_fingerprints_keep_all_rows(spark):
    rows = [(i, prose(1, 30)) for i in range(1500)] + [(2000 + i, prose(i, 30)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(tuple(r) for r in simhash.components(df).collect()) == plain_simhash(rows)
