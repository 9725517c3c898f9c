"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Base entities are found in every whole text by one pattern per kind. They seed a bootstrap over
the whole corpus, together with keys by their form (32 and more hexadecimal digits, letters and figures
among them), which are no base kind. What stands before an entity is a lexical pattern: the name that
something is assigned to (`token = "`, `user: `), whatever precedes it, or else the two words before. Every
other token that looks like an identifier (six or more letters, digits, "_" or "-", one digit at least)
is a possible instance of the pattern before it. Distinct (pattern, instance) pairs form a graph.
In each round a pattern is as reliable as the mean score of its instances, if enough of them are
certain, and an instance is as certain as one of its reliable patterns being right makes it
(noisy or). What is certain enough after the last round is reported as kind `id`, a key by its form
too only if a reliable pattern has it; base spans stay as they are.

Everything is DataFrame work. Only spans and contexts leave the texts; the graph has one row per
distinct pair, so copies and hot patterns are summed before they are shuffled.

Defined cases: a null text is empty. Spans are code points, the end exclusive. Repeated rows are
scanned each for itself but make one edge. A context is the last 64 characters before an entity, in which a
match of the same kind counts as one word; a longer word counts by what is left of it there, a single
one as a pattern of its own, and an entity that begins a text makes no edge. An empty table gives
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.functions.skew import lookup_join
from eventtally.llm.common import query, table
from eventtally.session import stored

SPAN = "struct<start:int,end:int,value:string,left:string>"
CONTEXT_CHARS = 64
# Matches that are laid out together.
BLOCK = 128
LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    """A pattern, text without which it cannot match, and a test of what it matched.

    The patterns are the plain ones with possessive repeats and a look at the character before, so
    that a run of characters is read once: a match can only start where its run starts.
    """

    name: str
    pattern: str
    hint: str

    def valid(self, value: Column) -> Column:
        if self.name == "ip":
            part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
            return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
        if self.name == "card":
            digits = F.regexp_replace(value, "[ -]", "")
            return F.length(digits).between(16, 19) & luhn(digits)
        if self.name == "phone":
            return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
        return F.lit(True)


KINDS = (
    Kind("email", rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", ""),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+"),
)
# A key by its form.
KEY = r"^(?=.*[A-Fa-f])(?=.*[0-9])[0-9A-Fa-f]{32,}$"
IDENTIFIER = Kind("id", r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{6,}+", "")


@dataclass(frozen=True)
class Bootstrap:
    """When a pattern and an instance are believed."""

    rounds: int = 3
    support: int = 5  # certain instances that a pattern needs
    reliable: float = 0.8  # mean score of a pattern's instances
    certain: float = 0.8  # score of an instance


def luhn(digits: Column) -> Column:
    """Whether the digits pass the check: every second one from the right is doubled."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, k: acc + doubled(F.substr(digits, -k, F.lit(1)).cast("int"), k % 2 == 0),
    )
    return total % 10 == 0


def doubled(digit: Column, second: Column) -> Column:
    return F.when(~second, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, kind: Kind) -> Column:
    """The valid matches as an array of (start, end, value, left).

    What lies between the matches gives the places: text is parts and matches in turn.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    turns = F.zip_with(between, found, lambda b, m: F.struct(b.alias("before"), m.alias("value")))
    none = F.array().cast(f"array<{SPAN}>")

    placeholder = F.lit(f" <{kind.name}> ")

    def step(acc: Column, turn: Column) -> Column:
        start = acc["at"] + F.length(turn["before"])
        end = start + F.coalesce(F.length(turn["value"]), F.lit(0))
        left = F.right(F.concat(acc["tail"], turn["before"]), F.lit(CONTEXT_CHARS))
        span = F.struct(
            start.alias("start"), end.alias("end"), turn["value"].alias("value"), left.alias("left")
        )
        kept = F.when(turn["value"].isNotNull() & kind.valid(turn["value"]), F.array(span)).otherwise(none)
        return F.struct(
            end.alias("at"), F.concat(acc["found"], kept).alias("found"), F.concat(left, placeholder).alias("tail")
        )

    # Arrays grow by copying, so long lists are laid out in blocks.
    def length(block: Column) -> Column:
        return F.aggregate(
            block,
            F.lit(0),
            lambda acc, t: acc + F.length(t["before"]) + F.coalesce(F.length(t["value"]), F.lit(0)),
        )

    def cut(turns: Column) -> Column:
        count = F.ceil(F.size(turns) / BLOCK).cast("int")

        def block(k: Column) -> Column:
            before = F.right(F.get(turns, k * BLOCK - 1)["before"], F.lit(CONTEXT_CHARS))
            tail = F.coalesce(F.concat(before, placeholder), F.lit(""))
            return F.struct(F.slice(turns, k * BLOCK + 1, F.lit(BLOCK)).alias("turns"), tail.alias("tail"))

        return F.transform(F.sequence(F.lit(0), count - 1), block)

    def lay(blocks: Column) -> Column:
        starts = F.aggregate(
            F.transform(blocks, lambda block: length(block["turns"])),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
            lambda acc, n: F.struct(
                (acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")
            ),
            lambda acc: acc["all"],
        )
        return F.flatten(
            F.zip_with(
                blocks,
                starts,
                lambda block, start: F.aggregate(
                    block["turns"],
                    F.struct(start.alias("at"), none.alias("found"), block["tail"].alias("tail")),
                    step,
                    lambda acc: acc["found"],
                ),
            )
        )

    laid = bound(bound(turns, cut), lay)
    possible = text.rlike("[0-9]") if not kind.hint else F.contains(text, F.lit(kind.hint))
    return F.when(possible, laid).otherwise(none)


def pattern_of(left: Column) -> Column:
    """The name that is assigned to, else the last two words, else the only one; digits are alike.

    Empty if nothing stands before an entity.
    """
    plain = F.translate(F.lower(left), "123456789", "000000000")
    name = F.regexp_extract(plain, r"([\p{L}_][\p{L}0_.-]*+)\s*+(?:=>|:=|=|:)\s*+[\"']?$", 1)
    two = F.regexp_replace(F.regexp_extract(plain, r"(\S+\s+\S+)\s*$", 1), r"\s+", " ")
    one = F.trim(F.regexp_replace(plain, r"\s+", " "))
    return (
        F.when(name != "", F.concat(name, F.lit(" =")))
        .when(two != "", two)
        .when(one != "", F.concat(F.lit("^ "), one))
        .otherwise(F.lit(""))
    )


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id, the base spans by kind, and the other identifiers of every document."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("text")).select(
        "doc_id", *(spans(F.col("text"), kind).alias(kind.name) for kind in (*KINDS, IDENTIFIER))
    )
    every = F.concat(*(F.col(kind.name) for kind in KINDS))
    other = F.filter(
        IDENTIFIER.name,
        lambda c: ~F.exists(every, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    return stored(
        base.withColumn(IDENTIFIER.name, other).withColumn("row", F.monotonically_increasing_id()), "spans"
    )


def occurrences(found: DataFrame) -> DataFrame:
    """row, start, end, instance, pattern, whether it is of a base kind and whether a seed, of all
    entities with a context."""

    def edges_of(kind: Kind) -> Column:
        return F.transform(
            kind.name,
            lambda s: F.struct(
                "row",
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.lower(s["value"]).alias("instance"),
                pattern_of(s["left"]).alias("pattern"),
                F.lit(kind is not IDENTIFIER).alias("base"),
                (s["value"].rlike(KEY) if kind is IDENTIFIER else F.lit(True)).alias("seed"),
            ),
        )

    columns = [edges_of(kind) for kind in (*KINDS, IDENTIFIER)]
    return found.select(F.explode(F.concat(*columns)).alias("o")).select("o.*").filter("pattern <> ''")


def certain_instances(found: DataFrame, rules: Bootstrap) -> DataFrame:
    """instance and score of the identifiers that the patterns make certain."""
    edges = stored(
        occurrences(found)
        .groupBy("pattern", "instance")
        .agg(F.max("base").alias("base"), F.max("seed").alias("seed")),
        "edges",
    )
    scores = edges.limit(0).select("instance", F.lit(0.0).alias("score"))
    for _ in range(rules.rounds):
        known = lookup_join(edges, scores, ["instance"], ["pattern"], "left").withColumn(
            "score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))
        )
        patterns = (
            known.groupBy("pattern")
            .agg(
                F.avg("score").alias("trust"),
                F.count_if(F.col("score") >= rules.certain).alias("support"),
                F.count_if(~F.col("base")).alias("open"),
            )
            .filter(
                (F.col("trust") >= rules.reliable) & (F.col("support") >= rules.support) & (F.col("open") > 0)
            )
            .select("pattern", "trust")
        )
        open_edges = edges.filter(~F.col("base")).select("pattern", "instance")
        wrong = F.exp(F.sum(F.log(1 - F.least("trust", F.lit(0.999)))))
        scores = stored(
            lookup_join(open_edges, patterns, ["pattern"], ["instance"])
            .groupBy("instance")
            .agg((1 - wrong).alias("score")),
            "scores",
        )
    return scores.filter(F.col("score") >= rules.certain)


def find_personal_data(docs: DataFrame, rules: Bootstrap = Bootstrap()) -> DataFrame:
    """doc_id, a column of spans per kind (start, end, value), `id` being what was discovered.

    `docs` has doc_id and text. Spans are in the order of their start.
    """
    found = scanned(docs)
    sure = certain_instances(found, rules)
    others = found.select("row", F.explode(IDENTIFIER.name).alias("s")).select(
        "row", "s", F.lower("s.value").alias("instance")
    )
    spotted = (
        lookup_join(others, sure.select("instance"), ["instance"], ["row"])
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("s")).alias(IDENTIFIER.name))
    )
    none = F.array().cast(f"array<{SPAN}>")
    rows = lookup_join(found.drop(IDENTIFIER.name), spotted, ["row"], ["row"], "left")
    return rows.select(
        "doc_id",
        *(F.col(kind.name) for kind in KINDS),
        F.coalesce(IDENTIFIER.name, none).alias(IDENTIFIER.name),
    )


def listed(kinds: tuple[Kind, ...]) -> Column:
    """kind:start:end of all spans, by kind and start, joined with commas."""

    def texts_of(kind: Kind) -> Column:
        return F.transform(kind.name, lambda s: F.concat_ws(":", F.lit(kind.name), s["start"], s["end"]))

    texts = [texts_of(kind) for kind in kinds]
    return F.array_join(F.concat(*texts), ",")


def masked(text: Column, kinds: tuple[Kind, ...] = (*KINDS, IDENTIFIER)) -> Column:
    """The text with every span replaced by its kind in angle brackets.

    Spans that overlap are taken in the order of their start, the longer first; what begins
    inside one that is taken is left out of the text with it.
    """

    def marks_of(kind: Kind) -> Column:
        mark = F.lit(f"<{kind.name.upper()}>")
        return F.transform(
            kind.name,
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("reach"), mark.alias("mark")),
        )

    spans_of = [marks_of(kind) for kind in kinds]
    ordered = F.array_sort(F.concat(*spans_of))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        inside = s["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], -s["reach"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, s["mark"])).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        ordered, zero, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text)))
    )


def without_personal_data(docs: DataFrame, rules: Bootstrap = Bootstrap()) -> DataFrame:
    """The documents with every span in `text` masked; other columns stay.

    Base spans are found where the text is read. Only what the patterns discovered is looked up,
    by a key of id and text; its places are written as text, so that they can be measured.
    """
    names = [kind.name for kind in (*KINDS, IDENTIFIER)]
    key = F.xxhash64("doc_id", "text")
    found = find_personal_data(docs.select(key.alias("doc_id"), "text"), rules)
    places = F.transform(IDENTIFIER.name, lambda s: F.concat_ws(":", s["start"], s["end"]))
    discovered = (
        found.filter(F.size(IDENTIFIER.name) > 0)
        .select(F.col("doc_id").alias("key"), F.array_join(places, ",").alias("places"))
        .distinct()
    )
    # All columns in one, so that none can clash with those added here.
    packed = docs.select(F.struct("*").alias("doc"), "text", key.alias("key"))
    known = lookup_join(packed, discovered, ["key"], ["text"], "left")
    place = F.split(F.coalesce("places", F.lit("")), ",")
    spread = F.transform(
        F.filter(place, lambda p: p != ""),
        lambda p: F.struct(
            F.substring_index(p, ":", 1).cast("int").alias("start"),
            F.substring_index(p, ":", -1).cast("int").alias("end"),
        ),
    )
    laid = known.select(
        "doc", *(spans(F.col("text"), kind).alias(kind.name) for kind in KINDS), spread.alias(IDENTIFIER.name)
    )
    return laid.select(
        *(
            F.when(F.size(F.concat(*(F.transform(n, lambda s: s["start"]) for n in names))) == 0, F.col("doc.text"))
            .otherwise(masked(F.col("doc.text")))
            .alias("text")
            if c == "text"
            else F.col(f"doc.`{c}`").alias(c)
            for c in docs.columns
        )
    )


@query()
def op1_personal_data(spark, sf_dir):
    """Counts, digest and spans of the personal data of every document."""
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(F.size(kind.name).cast("long").alias(f"n_{kind.name}") for kind in KINDS),
        F.sha2(listed(KINDS).cast("binary"), 256).alias("base_sha256"),
        listed((*KINDS, IDENTIFIER)).alias("spans"),
    )
