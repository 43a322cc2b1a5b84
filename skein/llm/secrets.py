"""Secret scan with DataFrame and SQL functions only.

Base patterns find assignments, access keys and long hex runs.  Beside them, every long run of key
characters, and every long piece of letters and digits in a run that is not flagged as a whole, is scored
by two character Markov chains - one of random strings, one of ordinary identifiers - and flagged when the
mean log-likelihood ratio of its transitions says "random".  Both
chains are trained from labelled samples of the corpus itself: the secrets that the base patterns
find, and the long runs of key characters in texts where they find none.  Counts are made by
``groupBy``; only the table of transitions, bounded by the square of the alphabet, reaches the driver.

Spark has no match positions: ``skein.functions.matches`` finds them with expressions.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.matches import finditer
from skein.functions.text import bind

# The three base patterns, and the shortest match (of an assignment: value) that counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
#: Whole runs are what the last two match, so a least count inside the pattern drops no other match.
ACCESS, HEX = "AKIA[A-Z0-9]{%d,}" % (ACCESS_MIN - 4), "[0-9a-f]{%d,}" % HEX_MIN
KINDS = ("assign", "access", "hex", "markov")

#: A candidate of the Markov test is a run of these characters, of the given length at least.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE_MIN = 16
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE_MIN
#: What separators leave of a run: a value behind a name, or beside a base span.
PIECE = "[A-Za-z0-9+]{%d,}" % CANDIDATE_MIN
#: Mean log-likelihood ratio of a transition (natural log) above which a candidate is a secret.
RATIO = 0.3
#: Added to every character's count, and the weight of character frequencies in a transition's estimate.
SMOOTH, PRIOR = 0.2, 3.0

#: Ordinary identifiers that every training starts from, beside those of the corpus.
IDENTIFIERS = """
get_user_name set_max_retry_count maxRetryCount defaultTimeoutSeconds http_request_handler parseInputStream
application_settings_file DatabaseConnectionPool INTERNATIONALIZATION environment_variable_name createTemporaryFolder
responseHeaderValue MAXIMUM_ALLOWED_LENGTH user-interface-component background-color-transparent src/main/resources
AbstractSingletonFactory notification_preferences lastModifiedTimestamp first_and_last_name CONTENT-DISPOSITION
documentation/getting-started configuration_management authenticationProvider number_of_iterations isValidEmailAddress
""".split()
#: Random strings of the same start: how many of each alphabet, and their length.
SEEDED, SEEDED_LENGTH = 400, 40

_SPANS = "array<struct<s:int,k:int,e:int,v:string>>"


def _none() -> Column:
    return F.expr(f"cast(array() as {_SPANS})")


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<s, k, e, v>>: start, kind's rank, end, match."""
    rank = F.lit(KINDS.index(kind))
    return F.transform(finditer(text, pattern), lambda m: F.struct(m["start"].alias("s"), rank.alias("k"), m["end"].alias("e"), m["match"].alias("v")))


def _value(match: Column) -> Column:
    """The value of an assignment."""
    return F.regexp_replace(match, ASSIGN_HEAD, "")


def base_spans(text: Column) -> Column:
    """Base spans by start, then kind as listed."""
    assign = F.filter(spans_of(text, ASSIGN, "assign"), lambda x: F.char_length(_value(x["v"])) >= ASSIGN_MIN)
    return F.array_sort(F.concat(assign, spans_of(text, ACCESS, "access"), spans_of(text, HEX, "hex")))


def seeded_counts() -> list[dict[str, float]]:
    """Transition counts of the built-in samples: [ordinary identifiers, random strings]."""
    n: list[dict[str, float]] = [{}, {}]
    for w in IDENTIFIERS:
        for a, b in zip(w, w[1:], strict=False):
            n[0][a + b] = n[0].get(a + b, 0) + 1
    for chars in (ALPHABET[:62], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[:66], "0123456789abcdef"):
        for k in range(SEEDED):
            bits = hashlib.sha512(f"{chars}{k}".encode()).digest()
            w = [chars[x % len(chars)] for x in bits[:SEEDED_LENGTH]]
            for a, b in zip(w, w[1:], strict=False):
                n[1][a + b] = n[1].get(a + b, 0) + 1
    return n


def train(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Log-likelihood ratio of each transition.

    Both chains start from ``seeded_counts`` (a corpus without secrets still gives a model); then the
    corpus adds its own labelled samples, the random ones capped at the seeds' weight by scaling, so
    that one format's frequency does not decide.

    Random strings: values of base matches.  Ordinary identifiers: long runs of key characters in
    texts without base matches.  Transitions are smoothed by character frequencies.  All rows are counted.
    """
    t = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t")).select("_t", base_spans(F.col("_t")).alias("_b"))
    random = F.transform("_b", lambda x: F.when(x["k"] == 0, _value(x["v"])).otherwise(x["v"]))
    plain = F.regexp_extract_all("_t", F.lit(CANDIDATE), F.lit(0))
    # outer generators: for inner ones the engine would look for matches twice, to filter rows without any
    v = t.select((F.size("_b") > 0).cast("int").alias("y"), F.explode_outer(F.when(F.size("_b") > 0, random).otherwise(plain)).alias("v"))
    pairs = v.select("y", F.explode_outer(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length("v") - 1, F.lit(1))), lambda i: F.substring(F.col("v"), i, F.lit(2)))).alias("p"))
    rows = pairs.where(F.col("p").rlike("^[A-Za-z0-9+/_=-]{2}$")).groupBy("y", "p").count().collect()  # 2 * 67^2 rows at most
    n = seeded_counts()
    seen = sum(r["count"] for r in rows if r["y"] == 1)
    scale = [1.0, min(1.0, sum(n[1].values()) / 2 / max(seen, 1))]
    for r in rows:
        n[r["y"]][r["p"]] = n[r["y"]].get(r["p"], 0) + r["count"] * scale[r["y"]]
    logs = [_log_chain(d) for d in n]
    return {p: logs[1][p] - logs[0][p] for p in logs[0]}


def _log_chain(n: dict[str, float]) -> dict[str, float]:
    """Log probability of each transition, smoothed towards the chain's own character frequencies."""
    of = {a: sum(n.get(a + b, 0) for b in ALPHABET) for a in ALPHABET}
    to = {b: sum(n.get(a + b, 0) for a in ALPHABET) + SMOOTH for b in ALPHABET}
    total = sum(to.values())
    return {a + b: math.log((n.get(a + b, 0) + PRIOR * to[b] / total) / (of[a] + PRIOR)) for a in ALPHABET for b in ALPHABET}


def mean_ratio(v: Column, model: dict[str, float]) -> Column:
    """Mean log-likelihood ratio of a candidate's transitions; 0 without a model."""
    if not model:
        return F.lit(0.0)
    table = F.expr("cast(split('" + ",".join(f"{model[a + b]:.5f}" for a in ALPHABET for b in ALPHABET) + "', ',') as array<double>)")
    place = F.expr("cast(split('" + ",".join(str(max(ALPHABET.find(chr(i)), 0)) for i in range(128)) + "', ',') as array<int>)")
    code = lambda i: F.get(place, F.ascii(F.substring(v, i, F.lit(1))))
    last = F.char_length(v) - 1
    return F.aggregate(F.sequence(F.lit(1), last), F.lit(0.0), lambda acc, i: acc + F.get(table, code(i) * len(ALPHABET) + code(i + 1))) / last


def _apart(spans: Column, taken: Column) -> Column:
    """The spans that touch none of those taken."""
    return F.filter(spans, lambda c: ~F.exists(taken, lambda x: (x["s"] < c["e"]) & (c["s"] < x["e"])))


def added_spans(text: Column, base: Column, model: dict[str, float], ratio: float = RATIO) -> Column:
    """Runs, and pieces of other runs, that look random and touch no base span."""
    if not model:
        return _none()
    random = lambda spans: F.filter(spans, lambda c: mean_ratio(c["v"], model) > ratio)

    def both(runs: Column) -> Column:
        whole = random(_apart(runs, base))
        pieces = lambda w: F.concat(w, random(_apart(_apart(spans_of(text, PIECE, "markov"), base), w)))
        return F.when(F.size(runs) > 0, bind(whole, pieces)).otherwise(_none())

    return bind(spans_of(text, CANDIDATE, "markov"), both)


def scan(docs: DataFrame, model: dict[str, float], text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """``docs`` with ``_text`` (never null), ``base`` and ``found`` (base and added, sorted): arrays of spans.

    A null or empty text has no spans.  All columns and repeated rows stay; columns already named like
    the results are replaced.  An empty table stays empty.
    """
    return (
        docs.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        .withColumn("base", base_spans(F.col("_text")))
        .withColumn("found", F.array_sort(F.concat("base", added_spans(F.col("_text"), F.col("base"), model, ratio))))
    )


def render(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mask``."""

    def step(acc: Column, x: Column) -> Column:
        kept = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], kept).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
