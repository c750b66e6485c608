"""Place detection and labelling of posts.

The defaults use word lists and stay inside the JVM. A model can be plugged in as a
pandas UDF column function instead: ``tagger(text) -> array<string>`` and
``classifier(text) -> struct<label: string, score: double>``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.fixed_values import BAD_WORDS, CITIES, GOOD_WORDS
from terravane.functions.numbers import let
from terravane.functions.strings import _col, word_text


def _as_words(name: str) -> str:
    """The form a name takes inside ``word_text``."""
    letters = "".join(ch if ch.isalpha() else " " for ch in name.lower())
    return " ".join(letters.split())


def listed_places(text: Column | str, places: Sequence[str] | None = None) -> Column:
    """Places of a list that the text names as whole words, each once.

    The list becomes part of the plan; ``place_mentions`` joins a gazetteer instead.
    """
    places = [c[0] for c in CITIES] if places is None else list(places)
    by_words = {_as_words(p): p for p in places}
    every_word = [w for words in by_words for w in words.split()]
    if len(every_word) == len(set(every_word)):
        return _places_in_one_pass(text, by_words)
    return _places_one_by_one(text, by_words)


def _places_in_one_pass(text: Column | str, by_words: dict[str, str]) -> Column:
    """One regular expression for all names. Names that share no word cannot overlap,
    so each mention is found although matches do not overlap either."""
    by_letter: dict[str, list[str]] = {}
    for words in by_words:
        by_letter.setdefault(words[0], []).append(words[1:].replace(" ", r"[^\p{L}]+"))
    names = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_letter.items())
    hits = F.regexp_extract_all(
        F.lower(_col(text)), F.lit(rf"(?<!\p{{L}})({names})(?!\p{{L}})"), F.lit(1))
    canonical = F.create_map(*[F.lit(x) for pair in by_words.items() for x in pair])
    return F.array_distinct(F.transform(
        hits, lambda h: canonical[F.regexp_replace(h, r"[^\p{L}]+", " ")]))


def _places_one_by_one(text: Column | str, by_words: dict[str, str]) -> Column:
    """One search per name. Without a lambda, generated code normalises the text once."""
    words = word_text(text)
    named = F.array(*[
        F.when(F.contains(words, F.lit(f" {w} ")), F.lit(p)) for w, p in by_words.items()
    ])
    return F.array_except(named, F.array(F.lit(None).cast("string")))


def detect_places(df: DataFrame, text: str = "text", places: Sequence[str] | None = None,
                  tagger: Callable[[Column], Column] | None = None,
                  alias: str = "city") -> DataFrame:
    """One row per row of ``df`` and distinct place its text names; other rows are dropped."""
    tagger = tagger or (lambda c: listed_places(c, places))
    return _per_place(df.withColumn("_places", F.array_distinct(tagger(F.col(text)))), alias)


def _per_place(df: DataFrame, alias: str) -> DataFrame:
    """Explode ``_places``.

    A plain ``explode`` makes the optimizer add a filter on the array, which it pushes
    below the projection that detects the places, so the texts would be scanned twice.
    The outer form has no such filter.
    """
    rest = [c for c in df.columns if c != "_places"]
    return (df.select(*rest, F.explode_outer("_places").alias(alias))
            .filter(F.col(alias).isNotNull()))


#: Bits of a gazetteer's filter, at most: 1 MB for each of the two kinds of codes.
FILTER_BITS = 23
_PLACE_BITS = 6  # of a bit inside a long


def _longer(code: Column, word: Column) -> Column:
    """Code of a run from that of the run without its last word."""
    return F.xxhash64(code, word)


@dataclass(frozen=True)
class NameFilter:
    """What is known of the names of a gazetteer: a fixed number of bits.

    ``starts`` has a bit for the code of every run of words that a name begins with, ``wholes``
    for every name, in longs; ``longest`` is the number of words of the longest name.
    """
    bits: int
    longest: int
    starts: list[int]
    wholes: list[int]

    def held(self, kind: str, code: Column) -> Column:
        place = F.shiftrightunsigned(code, 64 - self.bits)
        # one text that the optimizer turns into an array, not an expression per element
        longs = F.split(F.lit(",".join(map(str, getattr(self, kind)))), ",").cast("array<bigint>")
        slot = F.get(longs, F.shiftright(place, _PLACE_BITS).cast("int"))
        return F.bit_get(slot, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def name_filter(names: DataFrame, most_bits: int = FILTER_BITS) -> NameFilter:
    """The filter of names, arrays of words in the column ``words``. Runs when it is called.

    It takes about 16 bits for each beginning of a name, but 2^most_bits at most, which also
    bounds what reaches the driver. More names set more bits, so more runs pass that are no
    name, but none that is one is stopped.
    """
    runs, longest = names.agg(F.sum(F.size("words")), F.max(F.size("words"))).first()
    bits = min(max((16 * (runs or 0)).bit_length(), _PLACE_BITS + 1), most_bits)
    coded = names.select(F.aggregate(
        "words", F.array(F.lit(0).cast("bigint")),
        lambda codes, w: F.concat(codes, F.array(_longer(F.element_at(codes, -1), w)))).alias("codes"))
    each = coded.select(F.size("codes").alias("n"), F.posexplode("codes").alias("at", "code")).filter("at > 0")
    place = F.shiftrightunsigned("code", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    filled = each.groupBy(F.shiftright(place, _PLACE_BITS).alias("slot")).agg(
        F.bit_or(bit).alias("starts"),
        F.bit_or(F.when(F.col("at") == F.col("n") - 1, bit).otherwise(0)).alias("wholes"))
    starts, wholes = ([0] * (1 << bits - _PLACE_BITS) for _ in range(2))
    for r in filled.collect():  # at most as many rows as longs
        starts[r["slot"]], wholes[r["slot"]] = r["starts"], r["wholes"]
    return NameFilter(bits, longest or 0, starts, wholes)


def possible_names(words: Column, known: NameFilter) -> Column:
    """Runs of words that pass the filter: structs (at, code, length).

    Runs grow word by word and only while a name begins like that, so a run that is no
    beginning is not made longer.
    """
    def grown(runs: Column, length: Column) -> Column:
        longer = F.transform(F.filter(runs, lambda r: r["at"] + length <= F.size(words)), lambda r: F.struct(
            r["at"].alias("at"), _longer(r["code"], F.get(words, r["at"] + length - 1)).alias("code"),
            length.alias("length")))
        return F.filter(longer, lambda r: known.held("starts", r["code"]))

    def whole(runs: Column) -> Column:
        return F.filter(runs, lambda r: known.held("wholes", r["code"]))

    kind = "array<struct<at:int,code:bigint,length:int>>"
    first = F.filter(F.transform(words, lambda w, i: F.struct(
        i.alias("at"), _longer(F.lit(0).cast("bigint"), w).alias("code"), F.lit(1).alias("length"))),
        lambda r: known.held("starts", r["code"]))
    state = let(first, lambda runs: F.struct(runs.cast(kind).alias("runs"), whole(runs).cast(kind).alias("found")))
    if known.longest < 2:
        return state.getField("found")
    lengths = F.sequence(F.lit(2), F.lit(known.longest))
    return F.aggregate(lengths, state, lambda s, n: let(grown(s["runs"], n), lambda runs: F.struct(
        runs.cast(kind).alias("runs"), F.concat(s["found"], whole(runs).cast(kind)).alias("found")))).getField("found")


def place_mentions(df: DataFrame, text: str, gazetteer: DataFrame, keep: Sequence[str],
                   name: str = "place", alias: str = "city", filter_bits: int = FILTER_BITS) -> DataFrame:
    """The ``keep`` columns and the place, per (post, place), for a gazetteer of any size.

    A filter of fixed size is made from the beginnings of all names when this is called. Inside
    the row, runs of words grow from every word as long as they may begin a name; the
    few that may be whole names become texts, distinct in the row, and are joined to the
    gazetteer. So most words cost one look into the filter, names may have any number of
    words, and nothing needs a shuffle to be distinct. Keep an identifier rather than the
    text: the kept columns travel with every run when the gazetteer is too large to broadcast.
    An empty gazetteer or text names nothing.
    """
    dim = (gazetteer.groupBy(F.btrim(word_text(name)).alias("_run")).agg(F.min(name).alias(alias))
           .filter(F.col("_run") != ""))
    known = name_filter(dim.select(F.split("_run", " ").alias("words")), filter_bits)
    words = F.col("_words")
    split = df.select(*keep, F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "").alias("_words"))
    runs = F.transform(possible_names(words, known), lambda r: F.array_join(
        F.slice(words, r["at"] + 1, r["length"]), " "))
    return (split.select(*keep, F.explode(F.array_distinct(runs)).alias("_run"))
            .join(dim, "_run").select(*keep, alias))


def word_label(text: Column | str, good: Sequence[str] | None = None,
               bad: Sequence[str] | None = None) -> Column:
    """struct<label, score> by the balance of good and bad words.

    The score is the share of the winning side among all hits; a text without hits, or
    with a tie, is neutral with score 1 or 0.5.
    """
    def count(words: Column, listed: Sequence[str]) -> Column:
        return F.regexp_count(words, F.lit(f" ({'|'.join(listed)})(?= )"))

    def judge(c: Column) -> Column:
        hits, misses = c["hits"], c["misses"]
        label = (F.when(hits > misses, F.lit("good")).when(hits < misses, F.lit("bad"))
                 .otherwise(F.lit("neutral")))
        total = hits + misses
        score = F.when(total > 0, F.greatest(hits, misses) / total).otherwise(F.lit(1.0))
        return F.struct(label.alias("label"), score.alias("score"))

    counts = let(word_text(text), lambda words: F.struct(
        count(words, good or GOOD_WORDS).alias("hits"),
        count(words, bad or BAD_WORDS).alias("misses")))
    return let(counts, judge)


def enrich_posts(df: DataFrame, tagger: Callable[[Column], Column] | None = None,
                 classifier: Callable[[Column], Column] | None = None,
                 text: str = "text", created_at: str = "created_at") -> DataFrame:
    """created_at, city, assessment, score, text -- one row per post and city.

    Posts without a city are dropped and not classified.
    """
    tagged = df.withColumn("_places", F.array_distinct((tagger or listed_places)(F.col(text))))
    if classifier is not None:
        # The classifier may be a model: keep it away from posts without a place.
        labelled = tagged.filter(F.size("_places") > 0).withColumn(
            "_label", classifier(F.col(text)))
    else:
        labelled = tagged.withColumn(
            "_label", F.when(F.size("_places") > 0, word_label(F.col(text))))
    kept = labelled.select("_places", "_label", created_at, text)
    return _per_place(kept, "city").select(
        F.col(created_at).alias("created_at"), "city",
        F.col("_label.label").alias("assessment"), F.col("_label.score").alias("score"),
        F.col(text).alias("text"),
    )
