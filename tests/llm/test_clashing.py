"""Extra columns of any name, repeated rows and hostile records."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terravane.llm import (
    chat,
    decontaminate,
    labelled,
    line_dedup,
    mixing,
    near_copies,
    quality,
    queries,
    sharding,
    simhash,
    toxicity,
)

SF = "/root/testdata/sf0.001"
EXTRA = ("_id _d _t _s _h _at _hash _tie _text _gone _a _b spans size taken score n_sentences offending row id hash "
         "of at gone tie begin text_ Score Spans_ key lang_ copies shard_ slot range fp root least w.x").split()
EXTRA_OF = {c: f"v{i}" for i, c in enumerate(EXTRA)}
TEXTS = [(1, None, "a"), (2, "", None), (3, "One two three four five six", "a"), (3, "One two three four five six", "a"),
         (3, "other words, here", "b"), (4, "a\nb\nc\nd\na\nb\nc", "b"), (None, "no id at all", "c"),
         (None, "no id at all", "c"), (5, "you scum idiot " * 30, "c"), (6, " ".join(f"w{i}" for i in range(900)), "a")]


@pytest.fixture(scope="module")
def docs(spark):
    # names that differ by case only are a clash for Spark itself
    names = {c.lower(): c for c in EXTRA}
    schema = "doc_id long, text string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in names.values())
    rows = [(i, t, s, None if t is None else len(t), *(EXTRA_OF[c] for c in names.values())) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, schema)


def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 0, 1), (3, 0, 1)], "doc_id long, toxic int, quality int")


OPERATORS = {
    "toxicity": lambda s, d: toxicity.without_toxic(d, labels(s)),
    "near_copies": lambda s, d: near_copies.one_of_each(d),
    "simhash": lambda s, d: simhash.one_of_each(d),
    "documents": lambda s, d: decontaminate.decontaminate(d, bench(s), action="documents"),
    "spans": lambda s, d: decontaminate.decontaminate(d, bench(s), action="spans"),
    "mixing": lambda s, d: mixing.mixed_documents(d),
    "lines": lambda s, d: line_dedup.deduplicate_lines(d).drop("n_lines", "n_removed"),
    "shards": lambda s, d: sharding.assign(d, sharding.even_tree()).drop("shard"),
}


def bench(spark):
    return spark.createDataFrame([(1, "three four five six")], "item_id long, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_keep_their_values(spark, docs, name):
    out = OPERATORS[name](spark, docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and len(rows) <= len(TEXTS)
    extra = tuple(docs.first())[4:]
    assert all(tuple(r)[4:] == extra for r in rows)
    sources = defaultdict(set)
    for i, _, s in TEXTS:
        sources[i].add(s)
    assert all(r.source in sources[r.doc_id] for r in rows)
    assert OPERATORS[name](spark, docs.limit(0)).count() == 0


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_scores_beside_extra_columns(spark, docs, operator):
    model = operator.train(docs, labels(spark), label="quality" if operator is quality else "toxic")
    kept = operator.score(docs, model, keep=["doc_id", "text", "_text", "id"])
    assert kept.columns[:4] == ["doc_id", "text", "_text", "id"] and "score" in kept.columns
    assert kept.count() == len(TEXTS)
    assert {r.id for r in kept.collect()} == {EXTRA_OF["id"]}


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_contamination_is_reported_per_row(spark, docs, limit):
    got = decontaminate.report(docs, bench(spark), broadcast_bytes=limit).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in TEXTS)
    assert sum(r.contaminated for r in got) == 2  # both copies


def test_many_equal_rows_are_reported(spark):
    many = spark.range(200_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("three four five six").alias("text"))
    got = decontaminate.report(many, bench(spark))
    assert got.groupBy("doc_id", "n_hit", "contaminated").count().collect() == [(1, 4, True, 200_000)]


def test_sample_is_bounded_whatever_repeats(spark):
    docs = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    docs = docs.unionByName(spark.range(100, 200).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))
    marks = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    got = labelled.training_sample(docs, marks, "toxic", 400)
    ids = [i for i in range(200) if (i == 7 or i >= 100)]
    held = {r.doc_id for r in marks.where(labelled.held_out(F.col("doc_id"))).collect()}
    assert got.count() == sum(i not in held for i in ids)
    assert got.collect() == labelled.training_sample(docs.repartition(7), marks, "toxic", 400).orderBy(
        "text").collect() or got.count() <= 400


@pytest.mark.parametrize("operator, label", [(toxicity, "toxic"), (quality, "quality")])
def test_models_do_not_depend_on_the_order_of_rows(spark, operator, label):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    one, two = (operator.classify(d, known).select("doc_id", "score") for d in (docs, docs.repartition(5, "text")))
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}


HOSTILE = ['{"messages":["plain"]}', '{"messages":[null]}', '{"messages":[{}]}', '{"data.question":"q","data.answer":"a"}',
           r'{"prompt":"\ud800","completion":"a"}', r'{"\ud800":1}', '{"messages":[{"role":"user","content":"x"},"plain"]}',
           "[" * 100_000, '{"messages":[[]]}', "null", "3", '"x"', "{}"]


def test_hostile_records_are_rejected(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate([*HOSTILE, '{"messages":[]}'])], "key long, record string")
    got = {r.key: r for r in chat.format_records(df).collect()}
    for i, record in enumerate(HOSTILE):
        assert got[i].reject and got[i].formatted is None, record[:50]
    assert got[len(HOSTILE)].formatted == ""


def test_roles_with_line_ends_lose_no_turn(spark):
    turns = spark.createDataFrame([(1, 0, "user\nassistant", "x"), (2, 0, "system\nuser", "y"), (2, 1, "assistant", "z")],
                                  "conv_id long, turn long, role string, text string")
    records = chat.format_records(chat.conversation_records(turns))
    assert records.where("reject is not null").isEmpty()
    assert {(r.conv_id, r.n_turns) for r in chat.read_back(records).collect()} == {(1, 1), (2, 2)}


def test_registered_chat_query(spark):
    """Conversation -1 holds control strings and comes back like any other."""
    got = {r.conv_id: r for r in queries.op7_chat(spark, SF).collect()}
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    assert set(got) == {r.conv_id for r in turns.select("conv_id").distinct().collect()} | {-1}
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len("<|im_end|><|im_start|>assistant ok")
