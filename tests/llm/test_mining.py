"""Centroids, sharding, phrases and near copies against brute force, and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.llm import centroids, collocations, near_copies, queries, sharding, simhash

SF = "/root/testdata/sf0.001"
EXTRA = ", _id int, _d int, key string, n int, size string, shard2 int, w int, range int, slot2 int"
EXTRA_ROW = (77, 78, "k", 5, "big", 1, 2, 3, 4)
LONG = " ".join(f"wort{i % 977}é" for i in range(30_000))
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "One two three four five"), (5, "One two three four five"),
         (5, "One two three four five"), (5, "other words, here"), (6, LONG), (7, LONG[:-3] + "x y"),
         (None, "no id at all"), (None, "no id at all"), (8, "a b. a\tb, a  B;c a b!a b?x\ny"), (10, "日本 語　 x  y")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if (i or 0) % 2 else "en", None, *EXTRA_ROW) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string" + EXTRA)


# ---- centroids ----------------------------------------------------------------------------

def brute_clusters(vectors, k, rounds):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors if v is not None and len(v) == 64
            and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v)
                    for i, v in kept))
    centers = [v for _, _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if groups[n] else c
                   for n, c in enumerate(centers)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(
        ",".join(map(str, centers[c])).encode()).hexdigest()) for i, c, d in found)


@pytest.mark.parametrize("k", [16, 3])
def test_centroids(spark, k):
    random = np.random.default_rng(4)
    base = random.normal(size=(5, 64))
    rows = [(i, (base[i % 5] + random.normal(scale=0.3, size=64)).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[1][1]), (400, None), (401, []), (402, [1.0] * 63),
             (403, [None] + [1.0] * 63), (404, [float("nan")] * 64), (405, [float("-inf")] * 64),
             (406, [0.0] * 64), (407, [-0.0] * 64), (408, [1e6] * 64)]
    table = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows],
                                  "vec_id long, embedding array<double>, norm int, v string, cluster int")
    got = centroids.report(table, k=k)
    assert Counter(tuple(r) for r in got.collect()) == brute_clusters(rows, k, 3)


def test_centroids_of_few_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert centroids.report(spark.createDataFrame([], kind)).count() == 0
    two = [(1, [0.5] * 64), (2, [-0.5] * 64)]
    got = {r.vec_id: r for r in centroids.report(spark.createDataFrame(two, kind)).collect()}
    assert {r.distance for r in got.values()} == {0} and got[1].cluster != got[2].cluster
    with pytest.raises(Exception, match="after scaling"):
        centroids.report(spark.createDataFrame([(1, [1e30] * 64)], kind)).count()


def test_dot_products_stay_exact(spark):
    """After updates by changed components only, the matrix equals the full product."""
    random = np.random.default_rng(8)
    v = random.integers(-50, 50, (40, 64))
    rows = [(i, x.tolist(), int((x * x).sum()), [0] * 4) for i, x in enumerate(v)]
    state = spark.createDataFrame(rows, "vec_id long, v array<int>, norm long, dots array<long>")
    old = np.zeros((4, 64), np.int64)
    for _ in range(3):
        new = np.where(random.random((4, 64)) < 0.3, random.integers(-50, 50, (4, 64)), old)
        state = centroids.moved(state, old, new)
        old = new
    for r in state.collect():
        assert r.dots == (old @ v[r.vec_id]).tolist()
        assert r.distance == ((v[r.vec_id] - old[r.cluster]) ** 2).sum()


# ---- sharding -----------------------------------------------------------------------------

def brute_shard(key, tree):
    def draw(path, weight):
        digits = int(hashlib.md5(f"{'' if key is None else key}@{path}".encode()).hexdigest()[:13], 16)
        return -math.log((digits + 0.5) / 16**13) / weight

    r = min(range(len(tree.regions)), key=lambda r: draw(f"{r}", sum(w for k in tree.regions[r] for _, w in k)))
    region = tree.regions[r]
    k = min(range(len(region)), key=lambda k: draw(f"{r}/{k}", sum(w for _, w in region[k])))
    return min((draw(f"{r}/{k}/{i}", w), s) for i, (s, w) in enumerate(region[k]))[1]


def test_sharding(spark, odd):
    tree = sharding.even_tree(40)
    grown = tree.grown(40)
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = df.select("doc_id", "text").collect()
        got = sharding.slots(df, tree, grown, range_docs=2, run=1).collect()
        wanted = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()),
                          brute_shard(r.doc_id, tree), brute_shard(r.doc_id, grown)) for r in rows)
        assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == wanted
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert all(r.grown_shard in (r.shard, 40) for r in got)
    assert sharding.slots(odd.limit(0), tree).count() == 0
    assert sharding.slots(odd, tree).where("grown_shard is not null").count() == 0


def test_rows_move_only_where_weights_change(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = sharding.even_tree(40)
    racks = [list(r) for r in tree.regions]
    racks[1][2] = tuple((s, 3.0 if s == 31 else w) for s, w in racks[1][2])
    heavier = sharding.Tree(tuple(tuple(r) for r in racks))
    both = sharding.assign(sharding.assign(ids, tree, column="was"), heavier, column="now")
    moves = both.where("was <> now").select("was", "now").collect()
    assert moves and all(r.now >= 20 for r in moves)  # into the region that became heavier
    assert all(30 <= r.now < 35 for r in moves if r.was >= 20)  # inside it, into the heavier rack
    assert all(r.now == 31 for r in moves if 30 <= r.was < 35)  # inside that, into the shard
    sizes = Counter(r.now for r in both.collect())
    assert abs(sizes[31] / (20_000 * 3 / 42) - 1) < 0.1
    without = sharding.Tree(tuple(tuple(tuple((s, 0.0 if s < 5 else w) for s, w in k) for k in r) for r in tree.regions))
    assert sharding.assign(ids, without).where("shard < 5").count() == 0
    with pytest.raises(ValueError):
        sharding.Tree((((((0, 0.0),),)),))


def test_written_shards(spark, odd, tmp_path):
    tree = sharding.even_tree(7, per_rack=2, racks=2)
    sharding.write_shards(odd, str(tmp_path / "shards"), tree, file_rows=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(r.shard for r in back.collect()) == Counter(brute_shard(i, tree) for i, _ in TEXTS)
    assert Counter(map(tuple, back.select(*odd.columns).collect())) == Counter(map(tuple, odd.collect()))


# ---- phrases ------------------------------------------------------------------------------

def brute_phrases(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            for n in range(1, 5):
                counts[lang or "und"].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        f = {p: a for p, a in f.items() if a >= least}
        more = Counter()
        for p, a in f.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    more[p[i:i + m]] = max(more[p[i:i + m]], a)
        best = []
        for p, a in f.items():
            if len(p) > 1 and 100 * more[p] < 80 * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return Counter(out)


@pytest.mark.parametrize("least, top, bits", [(1, 2000, 28), (2, 40, 19), (3, 2000, 19)])
def test_collocations(spark, odd, least, top, bits):
    rows = [(r.lang, r.text) for r in odd.select("lang", "text").collect()]
    got = collocations.collocations(odd, least=least, top=top, filter_bits=bits)
    assert Counter(map(tuple, got.collect())) == brute_phrases(rows, least, top)
    assert collocations.collocations(odd.limit(0)).count() == 0


def test_false_pointers_are_noticed(spark, odd):
    """A fingerprint whose pointer leads to another phrase is not read as that phrase."""
    some = np.full(1 << 16, 255, np.uint8)
    counted = collocations.phrase_counts(odd, some, 0).cache()
    right = collocations.read_phrases(odd, counted, 0)
    assert right.where("not ok").isEmpty() and right.where("size = 4").count() > 900
    wrong = counted.withColumn("check", F.col("check").bitwiseXOR(F.lit(1))).where("size > 0")
    assert collocations.read_phrases(odd, wrong, 0).where("ok").isEmpty()
    other = counted.where("size = 2").withColumn("name", F.col("name") + 1)
    assert collocations.read_phrases(odd, other, 0).where("ok").isEmpty()


def test_filter_stops_no_name(spark):
    random = np.random.default_rng(5)
    names = random.integers(0, 2**64, 3000, dtype=np.uint64)
    table = spark.createDataFrame([(int(n),) for n in names.view(np.int64)], "name long")
    for most in (19, 28):
        bits = collocations.bit_filter(table, most)
        assert collocations.passes(bits, names).all()
    assert collocations.passes(bits, random.integers(0, 2**64, 20_000, dtype=np.uint64)).mean() < 0.01


def test_no_task_sends_all_frequent_phrases(spark):
    """Rows of the second pass follow the phrases, not phrases times tasks; pointers and counts stay."""
    texts = [(" ".join(f"w{(7 * i + j) % 150}" for j in range(150)) + f", u{i}", "en") for i in range(800)]
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(40).cache()
    short = collocations.short_counts(docs, 0, 30, range_bytes=20_000).cache()
    bits, ends = collocations.bit_filter(short), collocations.bit_filter(collocations.ends_of(short))
    plain, pointed = (collocations.phrase_counts(docs, bits, 0, e).where("size between 1 and 3").select(
        "name", "check", "n", "low", "high").join(short.select("name", "check", F.col("n").alias("whole")),
                                                  ["name", "check"]).collect() for e in (None, ends))
    assert len(plain) == 450 and all(r.n == r.whole for r in plain)
    assert {(r.name, r.check, r.whole, r.low, r.high) for r in plain} == {
        (r.name, r.check, r.whole, r.low, r.high) for r in pointed}
    before, after = (collocations.phrase_rows(docs, bits, 0, e).where("size between 1 and 3").count()
                     for e in (None, ends))
    assert before >= 40 * 450 and after < before / 3


def test_phrases_that_share_a_name_stay_apart():
    name, check = np.array([7, 9, 7, 7, 9], np.uint64), np.array([1, 4, 2, 1, 4], np.uint32)
    block = np.array([3, -128, 0, -5, 127], np.int8)
    got = collocations._short_added(name, check, np.array([1, 2, 3, 4, 5]), block, block)
    assert [tuple(map(int, r)) for r in zip(*got, strict=True)] == [
        (7, 1, 5, -5, 3), (7, 2, 3, 0, 0), (9, 4, 7, -128, 127)]


# ---- near copies --------------------------------------------------------------------------

def shingles(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def jaccard_groups(texts):
    """Smallest place of each text's group: chains of pairs of at least 0.8."""
    root, sets = list(range(len(texts))), [shingles(t) for t in texts]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def test_overlaps():
    random = np.random.default_rng(2)
    sets = [np.unique(random.integers(0, 9000, n)).astype(np.uint64) for n in (1, 5000, 7000, 300, 8000, 2)]
    shared = near_copies.overlaps(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert all(shared[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(6) for j in range(i))


@pytest.mark.parametrize("block", [1024, 8])
def test_near_copies_of_a_large_group(spark, block):
    """A third of the rows are changed copies of one text, some below the similarity to all."""
    random = np.random.default_rng(11)
    texts = []
    for group in range(60):
        words = [f"g{group}w{x}" for x in random.integers(0, 400, 80)]
        for _ in range(90 if group == 0 else 3):
            other = list(words)
            for at in random.integers(0, 80, random.integers(0, 5)):
                other[at] = f"x{random.integers(10**9)}"
            texts.append(" ".join(other))
    texts += texts[:40] * 2 + ["", None, " \n", "one two", "one  TWO"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lower = [None if t is None else t.lower() for t in texts]
    wanted = set(jaccard_groups(lower))
    kept = near_copies.one_of_each(docs, block_sets=block, block_shingles=block * 200)
    # wordless texts are one group
    wanted = {w for w in wanted if (texts[w] or "").split()} | {min(i for i, t in enumerate(texts) if not (t or "").split())}
    assert {r.doc_id for r in kept.collect()} == wanted


def test_near_copies_of_odd_rows(odd):
    kept = near_copies.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 4, 5, 6, 8, 10]
    assert all(tuple(r)[4:] == EXTRA_ROW for r in rows)
    assert near_copies.one_of_each(odd.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 4])
def test_near_copies_by_fingerprints_alone(spark, block):
    """Without bands, the pairs are those of similar sets in a group of linked fingerprints."""
    random = np.random.default_rng(13)
    texts = []
    for group in range(40):
        words = [f"g{group}w{x}" for x in random.integers(0, 900, 300)]
        for changed in (0, 1, 2, 4, 12):  # five shingles each
            other = list(words)
            for at in np.linspace(9, 290, changed).astype(int):
                other[at] = f"x{random.integers(10**9)}"
            texts.append(" ".join(other))
    texts += texts[:20] + [None, "", "a b", "a b a b a b", "a b a b a b a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, shingle=5).collect()}
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if linked[i] == linked[j] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    kept = {r.doc_id for r in near_copies.one_of_each(
        docs, bands=0, block_sets=block, block_shingles=block * 400).collect()}
    assert kept == set(root)
    # copies by fingerprints, and those that only the bands find
    assert any(len(sets[i] ^ sets[root[i]]) for i in range(200))
    assert len({r.doc_id for r in near_copies.one_of_each(docs).collect()}) < len(kept)


def test_queries_are_whole(spark):
    docs, vectors = (spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "embeddings"))
    assert queries.op12_sharding(spark, SF).count() == docs
    assert queries.op11_centroids(spark, SF).count() == vectors
