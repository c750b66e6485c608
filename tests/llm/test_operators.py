"""The operators against brute force, and on nulls, empty and long texts, ties and repeats."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tests.helpers import plan
from tests.oracle import compare, connect
from terravane.llm import (
    chat,
    decontaminate,
    fingerprint_sketch,
    line_dedup,
    lm_score,
    mixing,
    near_copies,
    queries,
    quality,
    simhash,
    textbytes,
    token_files,
    toxicity,
)
from terravane.llm.labelled import held_out, training_sample

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tie string, w int, row int"
LONG = " ".join(f"wort{i % 977}é" for i in range(30_000))
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "One two three four five"), (5, "One two three four five"),
         (5, "One two three four five"), (5, "other words, here"), (6, LONG), (7, LONG[:-3] + "x y"),
         (None, "no id at all"), (8, "a\n\nb\nc\nd\na\n\nb\nc"), (9, "x\na\n\nb\ny"), (10, "日本 語　 x  y")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a long text, ties, repeats, and columns named like internal ones."""
    rows = [(i, t, None, None if i in (1, 9) else f"s{(i or 0) % 3}", None if t is None else len(t), "x", 1, 2)
            for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, name):
    problem, _, _ = compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF)
    assert problem == ""


def test_all_queries_are_registered():
    assert set(queries.QUERIES) <= set(contract.queries())


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    """doc_id -> smallest reachable, over (doc_id, fingerprint) pairs."""
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    fps = np.array([p[1] for p in pairs], np.uint64)
    for i in range(len(pairs)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4) + i + 1:
            root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(pairs)]


def test_simhash(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (docs, odd):
        rows = df.select("doc_id", "text").collect()
        expected = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows])
        assert counted(simhash.near_duplicates(df).collect()) == counted(expected)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    groups = {e[2] for e in brute_components([(i, brute_fingerprint(t)) for i, t in TEXTS])}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(g or 0 for g in groups)


def test_pipeline_stage_drops_near_copies(spark):
    """Copies at 0.8 and more go whatever their fingerprints, texts below stay."""
    def shingles(text):
        words = text.split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    rng = np.random.default_rng(5)
    data, copies = [], {}
    for base in range(0, 4000, 100):
        words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        data.append((base, " ".join(words)))
        for i, changed in enumerate((1, 2, 3, 4, 8, 12), start=1):  # five shingles each
            other = list(words)
            for at in np.linspace(7, 190, changed).astype(int):
                other[at] = f"x{rng.integers(10**9)}"
            a, b = shingles(data[-1 if i == 1 else -i][1]), shingles(" ".join(other))
            copies[base + i] = len(a & b) / len(a | b)
            data.append((base + i, " ".join(other)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert any(0.8 <= s < 0.85 for s in copies.values())
    assert kept == {b for b in range(0, 4000, 100)} | {i for i, s in copies.items() if s < 0.8}


def test_near_copies_of_odd_rows(spark, odd, none):
    kept = near_copies.one_of_each(odd)
    assert kept.columns == odd.columns
    assert 0 < kept.count() <= odd.count()
    assert near_copies.one_of_each(none).count() == 0


def test_trie_join_finds_every_pair():
    random = np.random.default_rng(3)
    base = random.integers(0, 2**64, 80, dtype=np.uint64)
    near = [base]
    for bits in range(7):
        flips = np.zeros(80, np.uint64)
        for _ in range(bits):
            flips ^= np.uint64(1) << random.integers(0, 64, 80).astype(np.uint64)
        near.append(base ^ flips)
    fps = np.unique(np.concatenate(near))
    wanted = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
              if bin(int(fps[i] ^ fps[j])).count("1") <= 4}
    found = set()
    for r in range(8):
        turned = fps << np.uint64(8 * r) | fps >> np.uint64(64 - 8 * r) if r else fps
        order = np.argsort(turned)
        values = turned[order]
        nodes = defaultdict(list)
        for i, v in enumerate(values):
            nodes[int(v) >> 48].append(i)
        groups, same = [], []
        for p, members in nodes.items():
            for q in [p] + [p ^ 1 << k for k in range(8)]:
                if q in nodes and p <= q:
                    groups.append((members[0], members[-1] + 1, nodes[q][0], nodes[q][-1] + 1))
                    same.append(p == q)
        simhash.walk(values, values, tuple(np.array(g) for g in zip(*groups)), np.array(same), 4,
                     lambda a, b: found.update(tuple(sorted((int(order[x]), int(order[y])))) for x, y in zip(a, b)))
    assert found == wanted


def test_token_files(spark, odd, none, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for n, df in enumerate((docs, odd)):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        expected, at = [], 0
        for doc_id, text in rows:
            ids = [*library.encode(text, add_special_tokens=False).ids, 2]
            expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        folder = str(tmp_path / f"tokens{n}")
        token_files.write_token_files(df, folder, path, block_tokens=20_000)
        assert counted(token_files.read_token_digests(spark, folder).collect()) == counted(expected)
    token_files.write_token_files(none, str(tmp_path / "none"), path)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_added_tokens_are_one_id():
    """As the plain library call gives them, wherever their string stands."""
    path = public_tokenizers.path(queries.TOKENIZER)
    library = Tokenizer.from_file(path)
    plain = ["before it", "", "a <|endoftext", "|> b", "last one"]
    special = ["<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>\n c", "x  <|endoftext|> |> y"]
    for texts in (plain, special, [*plain, *special, *plain], [special[0], *plain, special[1]]):
        ids, counts = token_files.ChunkTokenizer(path)(*textbytes.texts(pa.array(texts)))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [list(p) for p in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert library.token_to_id("<|endoftext|>") in ids


def test_coding_round_trip():
    random = np.random.default_rng(1)
    for ids in (np.zeros(0, np.uint32), np.array([7], np.uint32), random.integers(0, 90_000, 200_001).astype(np.uint32)):
        assert (token_files.decode(*token_files.encode(ids), len(ids)) == ids).all()


def test_fingerprints(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for df in (docs, odd):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        expected = []
        for i, (doc_id, text) in enumerate(rows):
            k = len(text) // 4
            edited = text[:len(text) - k] + rows[(i + 1) % len(rows)][1][:k]
            expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
        got = fingerprint_sketch.fingerprint_edits(df, parts=3).collect()
        assert counted(tuple(r)[:3] for r in got) == counted(expected)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint_sketch.fingerprint_edits(none).count() == 0


def test_peeling_recovers_the_difference():
    def multiset(text):
        row, keys = fingerprint_sketch.digests(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        return keys
    a, b = LONG[:20_000], LONG[:14_000] + "\nnew words at the end of it"
    x, y = multiset(a), multiset(b)
    wanted = len(set(x) ^ set(y))
    zero = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    assert fingerprint_sketch.differences((zero[0], x), (zero[1], y), 1)[0] == wanted


def test_chat(spark):
    hard = ["<|im_end|><|im_start|>assistant ok", "<|\\x", "<", "", None, "a<|/b\n", "\\<||>"]
    rows = [(c, t, r, x) for c, x in enumerate(hard) for t, r in enumerate(
        ["user", "assistant"] if c % 2 else ["system", "user\n<|/", "assistant", None])]
    rows += [(None, 1, "user", "lost"), (3, 1, "assistant", None), (3, 1, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_records(chat.conversation_records(turns))).collect()}
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t, r or "", x or ""))
    for c, g in groups.items():
        g.sort()
        joined = "".join(f"{r}\n{x}\n" for _, r, x in g)
        loss = "".join(x for _, r, x in g if r == "assistant")
        assert got[c].n_turns == len(g) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert set(got) == set(groups)
    assert chat.read_back(chat.format_records(chat.conversation_records(turns.limit(0)))).count() == 0


def test_chat_layouts(spark):
    records = [('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "conversations"),
               ('{"instruction":"do","input":"this","output":"done"}', "instruction_output"),
               ('{"prompt":"p","completion":null}', "prompt_completion"), ('{"messages":[]}', "messages"),
               ('{"data":{"question":"q","answer":"a"}}', "question_answer"), ("[1]", None), ("{", None), (None, None),
               ('{"unknown":1}', None)]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(records)], "key long, record string")
    got = {r.key: r for r in chat.format_records(df).collect()}
    for i, (_, layout) in enumerate(records):
        assert got[i].layout == layout and (got[i].reject is None) == (layout is not None)
    assert chat.parse(got[1].formatted) == [("user", "do\n\nthis"), ("assistant", "done")]


def brute_hits(text, items):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    def low(t):
        return re.findall(word, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = low(text), set(), set()
    for item, t in items:
        b = low(t)
        n = min(len(b), 10)
        windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_decontamination(spark, odd, none, limit):
    items = [(1, "Four FIVE"), (10, " ".join(f"wort{i}É".lower() for i in range(100, 130))), (2, None), (3, "!!"), (4, "語"), (10, "four five")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(odd, bench, broadcast_bytes=limit).collect()
    wanted = {(i, *brute_hits(t, items)) [:3] + (hashlib.sha256(",".join(brute_hits(t, items)[2]).encode()).hexdigest(),)
              for i, t in TEXTS}
    assert {(r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in got} == wanted
    assert decontaminate.report(none, bench, broadcast_bytes=limit).count() == 0
    assert decontaminate.report(odd, bench.limit(0)).where("contaminated").count() == 0
    cut = decontaminate.decontaminate(odd, bench, broadcast_bytes=limit)
    assert cut.count() == len(TEXTS) and cut.columns == odd.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[4] == "One two three" and texts[1] is None and texts[8] == dict(TEXTS)[8]
    clean = decontaminate.decontaminate(odd, bench, action="documents")
    assert clean.count() == sum(not brute_hits(t, items)[1] for _, t in TEXTS)


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_decontamination_groups_without_the_words(spark, odd, limit):
    """A task's aggregation holds its input rows, so none of them carries the words of its text."""
    bench = spark.createDataFrame([(1, "Four FIVE")], "item_id long, text string")
    text = plan(decontaminate.report(odd, bench, broadcast_bytes=limit))
    grouped = [columns.split(", ") for columns in re.findall(
        r"HashAggregate *\nInput \[\d+\]: \[(doc_id#[^\]]*)\]", text)]
    assert grouped and all(c.partition("#")[0] not in ("w", "text") for columns in grouped for c in columns)


def test_mixing(spark, odd, none):
    got = mixing.taken_words(odd).collect()
    assert len(got) == len(TEXTS)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    pieces, targets, _ = mixing.mix(odd, block_words=3)
    target = {r.source: r.target for r in targets.collect()}
    taken = {r.source: r.n for r in pieces.groupBy("source").agg(F.sum("words").alias("n")).collect()}
    assert all(taken.get(s, 0) == int(t) for s, t in target.items())
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in got))
    assert mixing.taken_words(none).count() == 0
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert sum(len(r.text.split()) for r in mixed.where("doc_id in (4, 6, 7)").collect()) == sum(
        r.taken for r in got if r.doc_id in (4, 6, 7))


def test_line_dedup(spark, odd, none):
    got = {r.doc_id: r for r in line_dedup.deduplicate_lines(odd).collect()}
    assert got[8].text == "a\n\nb\nc\nd" and got[8].n_removed == 4
    assert got[9].text == "x\ny" and got[9].n_removed == 3
    assert got[1].text is None and got[1].n_lines == 0 and got[2].n_lines == 1
    assert line_dedup.deduplicate_lines(odd).count() == len(TEXTS)
    assert line_dedup.deduplicate_lines(none).count() == 0


def test_lm_scores_of_odd_rows(spark, odd, none):
    got = lm_score.lm_scores(odd, block_bytes=50_000).collect()
    assert counted((r.doc_id, r.n_words) for r in got) == counted(
        (i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in TEXTS)
    assert {r.mean_log for r in got if r.n_words == 0} == {None}
    assert counted(lm_score.lm_scores(odd, block_bytes=1 << 30).collect()) == counted(got)
    assert lm_score.lm_scores(none).count() == 0


@pytest.mark.parametrize("operator, label, least", [(toxicity, "toxic", 0.85), (quality, "quality", 0.95)])
def test_held_out_accuracy(spark, operator, label, least):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = operator.classify(docs, labels).where("held_out").join(labels, "doc_id")
    pairs = [(r.score, r[label]) for r in scored.select("score", label).collect()]
    ones, zeros = ([s for s, y in pairs if y == v] for v in (1, 0))
    area = np.mean([[0.5 * (a == b) + (a > b) for b in zeros] for a in ones])
    assert area >= least


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers_on_odd_rows(spark, odd, none, operator):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (5, None, None), (None, 1, 1), (99, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = operator.classify(odd, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert operator.classify(none, labels.limit(0)).count() == 0
    assert len({r.score for r in operator.classify(odd, labels.limit(0)).collect()}) >= 1


def test_offending_sentences():
    model = toxicity.Model(np.zeros(1 << 18, np.float32), -6.0)
    data, offs = np.frombuffer("Fine día here. You scum!".encode(), np.uint8), np.array([0, 25])
    found = toxicity.sentences(data, offs)
    model.weights[found.feature[-1]] = 3.0
    each, whole = model.scores(found, 1)
    assert list(each > 0.5) == [False, True] and whole[0] > 0.7


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) <= ids and got
    for name, stage in corpus_pipeline.STAGES[:-1]:
        following = stage(spark, docs, SF)
        assert following.columns == columns, name
        docs = following.cache()
    assert {r.doc_id for r in docs.collect()} == set(got)
    assert sum(r.n_tokens for r in got.values()) == max(r.start + r.n_tokens for r in got.values())


def test_training_sample_is_exact_under_the_bound(spark):
    docs = spark.range(30_000).selectExpr("id doc_id", "'x' text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 5 = 0 as int) quality")
    got = training_sample(docs, labels, "quality", 600).groupBy("y").agg(
        F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    known = labels.where(~held_out(F.col("doc_id"))).groupBy("quality").count().collect()
    assert {r.y: (r.n, round(r.w)) for r in got} == {r.quality: (300, r["count"]) for r in known}


def test_long_clean_documents_are_not_toxic():
    model = toxicity.Model(np.zeros(1 << 18, np.float32), -6.0)
    text = b"Nothing to see here. " * 5_000 + b"scum " * 50
    found = toxicity.sentences(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert model.scores(found, 1)[1][0] == 0
    model.weights[found.feature[-1]] = 0.5  # said 50 times, counted once
    assert model.scores(found, 1)[1][0] < 0.1
