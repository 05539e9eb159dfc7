"""Campaign conditions held in a table and matched through an index.

A condition is a row: ``campaign_id, parameter, operator, value`` with operator '=', 'sub' or
'~'. Its test is indexed by what every value that passes must contain: the whole value for
'=', one short substring (gram) for 'sub', and a gram of a literal that cannot be missing for
'~'. Tests are run once on the distinct values of a parameter, and campaigns are looked up
once for the distinct sets of passed tests, so neither a value nor a set that a third of all
visits share costs more than one. The plan is the same for ten conditions and ten million.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.session import settled

#: Length of a gram; shorter texts are their own gram.
GRAM = 3
#: Stands for all that is no certain literal of a regular expression.
GAP = "\x01"


def grams(text: Column, lengths: Column) -> Column:
    """The distinct substrings of a text of each of ``lengths``; the empty one for length 0.

    The text is cut into characters once, so the work is in proportion to its length.
    """
    signs = F.filter(F.split(text, ""), lambda c: c != "")
    none = F.array().cast("array<string>")

    def of_length(chars: Column, k: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(chars) - k + 1, F.lit(1)))
        pieces = F.transform(places, lambda at: F.array_join(F.slice(chars, at, k), ""))
        return F.when(k == 0, F.array(F.lit(""))).when(F.size(chars) >= k, pieces).otherwise(none)

    every = F.transform(F.array(signs), lambda chars: F.flatten(F.transform(lengths, lambda k: of_length(chars, k))))
    return F.array_distinct(every[0])


def literal_of(pattern: Column) -> Column:
    """A literal that every match of a regular expression contains; '' where none is certain.

    Escapes, classes, groups, anchors and characters that may be absent are cut out; of what
    is left between the cuts, the longest part is taken. An alternative outside of groups,
    groups nested more than twice, inline flags, quotations and escapes by number or name
    leave nothing certain.
    """
    quantifier = r"([*+?]|\{[^}]*\})*"
    cuts = (
        r"(?s)\\.",  # an escaped sign or a class by letter
        r"\[\^?\]?[^\]]*\]" + quantifier,
        r"\([^()]*\)" + quantifier,
        r"\([^()]*\)" + quantifier,
        r"(?s).([*?]|\{[^}]*\})[+?]?",  # a character that may be absent
        r"\+[+?]?",
        r"[.^$]",
    )
    kept = pattern
    for cut in cuts:
        kept = F.regexp_replace(kept, cut, GAP)
    longest = F.aggregate(
        F.split(kept, GAP), F.lit(""), lambda a, p: F.when(F.char_length(p) > F.char_length(a), p).otherwise(a)
    )
    unsure = pattern.rlike(r"\(\?|\\[^dDwWsSbBntrAzZ\W]") | kept.rlike(r"[|()\[\]{}\\]")
    return F.when(unsure, F.lit("")).otherwise(longest)


def tests_of(conditions: DataFrame) -> DataFrame:
    """Distinct tests: ``test, parameter, operator, value, need``; ``need`` is the literal that
    a value must contain. NULL in a condition is no test: its campaign never matches."""
    asked = conditions.select("parameter", "operator", "value").dropna().distinct()
    known = asked.filter(F.col("operator").isin("=", "sub", "~"))
    need = F.when(F.col("operator") == "~", literal_of(F.col("value"))).otherwise(F.col("value"))
    return known.select(F.monotonically_increasing_id().alias("test"), "*", need.alias("need"))


def passed(values: DataFrame, tests: DataFrame) -> DataFrame:
    """``parameter, text, test``: which tests the distinct ``parameter, text`` pass."""
    equal = tests.filter("operator = '='").select("parameter", F.col("value").alias("text"), "test")
    by_value = values.join(equal, ["parameter", "text"])
    rest = tests.filter("operator <> '='")
    length = F.least(F.char_length("need"), F.lit(GRAM))
    lengths = rest.groupBy("parameter").agg(F.sort_array(F.collect_set(length)).alias("lengths"))
    pieces = settled(
        values.join(lengths, "parameter").select(
            "parameter", "text", F.explode(grams(F.col("text"), F.col("lengths"))).alias("gram")
        ),
        "grams",
    )
    often = pieces.groupBy("parameter", "gram").agg(F.count("*").alias("often"))
    own = rest.withColumn("gram", F.explode(grams(F.col("need"), F.array(length))))
    own = own.join(often, ["parameter", "gram"], "left")
    # a gram that no value has decides the test: min_by takes it first, and the join drops it
    rarest = own.groupBy("test", "parameter", "operator", "value").agg(
        F.min_by("gram", F.struct(F.coalesce("often", F.lit(0)), "gram")).alias("gram")
    )
    text, value = F.col("text"), F.col("value")
    holds = F.when(F.col("operator") == "sub", F.contains(text, value)).otherwise(F.rlike(text, value))
    found = pieces.join(rarest, ["parameter", "gram"]).filter(holds)
    return by_value.select("parameter", "text", "test").unionByName(found.select("parameter", "text", "test"))


def profiles(visits: DataFrame, id: str, conditions: DataFrame, tests: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``id, extra, tests``: the sorted tests that each visit passes; visits that pass none are
    left out. Parameters that the visits don't have as a column are passed by none."""
    names = [c for c in visits.columns if c != id]
    texts = [F.struct(F.lit(c).alias("parameter"), F.col(c).cast("string").alias("text")) for c in names]
    wide = visits.select(id, *extra, F.explode(F.array(*texts)).alias("v")).select(id, *extra, "v.*")
    wide = wide.filter(F.col("text").isNotNull())
    asked = conditions.select("parameter").distinct()
    wide = wide.join(asked, "parameter", "left_semi")
    values = settled(wide.select("parameter", "text").distinct(), "values")
    by_value = passed(values, tests).groupBy("parameter", "text").agg(F.collect_list("test").alias("own"))
    return (
        wide.join(by_value, ["parameter", "text"])
        .groupBy(id, *extra)
        .agg(F.sort_array(F.flatten(F.collect_list("own"))).alias("tests"))
    )


def _distinct_profiles(rows: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a key of their profile, and each profile once."""
    key = F.sha2(F.to_json(F.struct(*extra, "tests")), 256)
    rows = settled(rows.withColumn("profile", key), "profiles")
    once = rows.groupBy("profile").agg(F.any_value("tests").alias("tests"), *[F.any_value(c).alias(c) for c in extra])
    return rows.drop("tests"), once


def _campaign_tests(conditions: DataFrame, tests: DataFrame) -> DataFrame:
    """``campaign_id, test, parameter`` and how many conditions ask for it."""
    return (
        conditions.join(tests.select("test", "parameter", "operator", "value"), ["parameter", "operator", "value"])
        .groupBy("campaign_id", "test", "parameter")
        .agg(F.count("*").alias("times"))
    )


def assign_campaigns(visits: DataFrame, id: str, conditions: DataFrame) -> DataFrame:
    """``id, campaign_id``: a row per visit and campaign all of whose conditions hold.

    ``visits`` has the parameters as columns and a unique ``id``. Matched tests are counted
    against those that the campaign requires, for each distinct set of passed tests.
    """
    tests = settled(tests_of(conditions), "tests")
    need = conditions.groupBy("campaign_id").agg(F.count_distinct("parameter", "operator", "value").alias("n"), F.count_if(
        F.col("parameter").isNull() | F.col("operator").isNull() | F.col("value").isNull()).alias("void"))
    need = need.filter("void = 0").select("campaign_id", F.col("n").alias("required"))
    rows, once = _distinct_profiles(profiles(visits, id, conditions, tests))
    met = (
        once.select("profile", F.explode("tests").alias("test"))
        .join(_campaign_tests(conditions, tests), "test")
        .groupBy("profile", "campaign_id")
        .agg(F.count("*").alias("met"))
        .join(need, "campaign_id")
        .filter("met = required")
        .select("profile", "campaign_id")
    )
    return rows.join(met, "profile").select(id, "campaign_id")


def score_campaigns(visits: DataFrame, id: str, conditions: DataFrame, weights: DataFrame, site: str = "site_id") -> DataFrame:
    """``id, score, campaign_id``: the best campaign of every visit.

    Every condition that holds adds its parameter's weight at the visit's site; the highest
    score wins, the lower campaign id on ties; a score of 0 assigns none (NULL).
    """
    tests = settled(tests_of(conditions), "tests")
    single = weights.groupBy(site, "parameter").agg(F.max("weight").alias("weight"))
    rows, once = _distinct_profiles(profiles(visits, id, conditions, tests, (site,)), site)
    best = (
        once.select("profile", site, F.explode("tests").alias("test"))
        .join(_campaign_tests(conditions, tests), "test")
        .join(single, [site, "parameter"])
        .groupBy("profile", "campaign_id")
        .agg(F.sum(F.col("weight") * F.col("times")).alias("score"))
        .filter("score > 0")
        .groupBy("profile")
        .agg(F.max("score").alias("score"), F.min_by("campaign_id", F.struct(-F.col("score"), "campaign_id")).alias("campaign_id"))
    )
    scored = rows.join(best, "profile").select(F.col(id).alias("__id"), "score", "campaign_id")
    return (
        visits.select(id).join(scored, F.col(id) == F.col("__id"), "left")
        .select(id, F.coalesce("score", F.lit(0)).alias("score"), "campaign_id")
    )
