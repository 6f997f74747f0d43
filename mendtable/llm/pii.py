"""Personal data by weak supervision, in DataFrame functions only.

The base spans are the leftmost, non-overlapping matches of one pattern for each kind that pass its
check; they always stay. The method looks further: every match of the base patterns, passing or not,
and of wider patterns (masked e-mail addresses, numbers without a country code, long IP addresses) is
a candidate, on which labelers vote yes, no or not at all:

* regex: does the match pass the base check;
* shape: does it have the usual number of digits or parts;
* gazetteer: does it start or end with a known part (card issuers, top-level domains, area codes);
* context: does a word for the kind stand close before it, or a word for other numbers right before it;
* surroundings: does it stand free, rather than inside a longer number or after a word for versions.

Votes are counted by pattern, a few hundred numbers at most, and expectation-maximisation estimates
from these counts how common each kind is among its candidates and how reliable each labeler is. The
posterior of each vote pattern is a soft label, and a naive Bayes classifier over features of the span
itself (its shape, length, neighbours and cue) is trained on the soft labels of all candidates. A
candidate that is no base span becomes a span if the votes and the classifier both say so
(``CERTAIN``) and no base span of its kind overlaps it.

Positions are code points, ends exclusive. Patterns use possessive loops, which neither go back nor
recurse, so a long text of digits is no danger. Null and empty texts have no spans. Rows that share id
and text get the same result; a null id is an id. An empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendtable.functions.columns import local_table

from .common import let, same, slim, stored, text_key

KINDS = ("email", "ip", "card", "phone")
CERTAIN = 0.9
CUE_REACH = 40
FEATURE_BUCKETS = 4096

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]++"

# An address can only start where its run of letters starts, or where the last match ended; so no
# place within a run is tried in vain.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[({]\x20?at\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[({]\x20?dot\x20?[\])}])\x20?[A-Za-z0-9-]{1,63})++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# cheap tests that any text with a match passes
_WORTH = {
    ("base", "email"): lambda t: F.contains(t, F.lit("@")),
    ("base", "ip"): lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
    ("base", "card"): lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
    ("base", "phone"): lambda t: F.contains(t, F.lit("+")),
    ("wide", "email"): lambda t: t.rlike(r"(?i)[\[({]\x20?at\x20?[\])}]"),
    ("wide", "ip"): lambda t: t.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]"),
    ("wide", "phone"): lambda t: t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"),
}

# fixed values: words and parts the labelers know
CUES = {
    "email": "mail|contact|write|correo|courriel|kontakt",
    "ip": "\\bip\\b|host|server|addr",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|telefon|appel",
}
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us|it|nl|ch|at"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
VERSIONS = "(?i)(?:version|release|section|chapter|isbn|serial|invoice|order|§)[\\s:#.]*$"


# ------------------------------------------------------------------ candidates


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check of card numbers: every second digit from the right
    counts twice, less 9 if that has two digits."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _passes(kind: str, body: Column) -> Column:
    digits = _digits(body)
    if kind == "ip":
        return F.forall(F.split(body, "\\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(source: str, kind: str, pattern: str) -> Column:
    """The matches of a pattern, in order: the text before since the last one, and around them."""
    text = F.col("text")

    def pair(both: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(both["bodies"]) - 1),
            lambda i: F.struct(
                F.lit(source).alias("source"),
                F.lit(kind).alias("kind"),
                i.alias("i"),
                F.char_length(F.get(both["gaps"], i)).alias("gap"),
                F.get(both["bodies"], i).alias("body"),
                F.right(F.get(both["gaps"], i), F.lit(CUE_REACH)).alias("before"),
                F.left(F.get(both["gaps"], i + 1), F.lit(8)).alias("after"),
            ),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(found.alias("bodies"), F.split(text, pattern, -1).alias("gaps"))
    some = F.size(found) > 0
    return F.when(_WORTH[source, kind](text) & some, let(both, pair))


def candidates(docs: DataFrame) -> DataFrame:
    """Matches of all patterns in rows (doc_id, doc_key, text): source, kind, body, before, after, start,
    stop (code points) and base (whether it is a base span)."""
    lists = [_matches("base", k, p) for k, p in BASE.items()] + [_matches("wide", k, p) for k, p in WIDE.items()]
    none = F.array()
    each = docs.select("doc_id", "doc_key", F.explode(F.concat(*(F.coalesce(x, none) for x in lists))).alias("m"))
    each = each.select("doc_id", "doc_key", "m.*").distinct()
    size = F.char_length("body")
    earlier = Window.partitionBy("doc_id", "doc_key", "source", "kind").orderBy("i")
    placed = each.withColumn("stop", F.sum(F.col("gap") + size).over(earlier)).withColumn("start", F.col("stop") - size)
    ok = F.lit(False)
    for k in KINDS:
        ok = F.when(F.col("kind") == k, _passes(k, F.col("body"))).otherwise(ok)
    return placed.withColumn("base", (F.col("source") == "base") & ok).drop("i", "gap")


# ------------------------------------------------------------------ labelers and their reliability

LABELERS = ("regex", "shape", "gazetteer", "context", "surroundings")


def votes() -> dict[str, Column]:
    """1 for yes, 0 for no, -1 for no vote."""
    kind, body = F.col("kind"), F.col("body")
    n = F.length(_digits(body))
    wide = F.col("source") == "wide"

    def by_kind(**of: Column) -> Column:
        out = F.lit(-1)
        for k, vote in of.items():
            out = F.when(kind == k, vote).otherwise(out)
        return out

    def says(yes: Column) -> Column:
        return F.when(yes, 1).otherwise(0)

    cue = F.lit(False)
    for k, words in CUES.items():
        cue = F.when(kind == k, F.col("before").rlike(f"(?i)(?:{words})")).otherwise(cue)
    inside = F.col("before").rlike("[0-9][.,-]?$") | F.col("after").rlike("^[.,-]?[0-9]") | F.col("before").rlike(VERSIONS)
    return {
        "regex": F.when(wide, -1).otherwise(says(F.col("base"))),
        "shape": by_kind(
            email=says(F.length(body) <= 80),
            ip=says(body.rlike("^(?:[0-9]{1,3}\\.){3}[0-9]{1,3}$|:")),
            card=says(n.isin(15, 16)),
            phone=says(n.isin(10, 11, 12)),
        ),
        "gazetteer": by_kind(
            email=says(body.rlike(f"(?i)(?:{DOMAINS})$")),
            ip=says(body.rlike("^(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])\\.|:")),
            card=says(_digits(body).rlike(ISSUERS)),
            phone=says(_digits(body).rlike("^1?[2-9]")),
        ),
        "context": F.when(F.col("before").rlike(VERSIONS), 0).when(cue, 1).otherwise(-1),
        "surroundings": says(~inside),
    }


def reliabilities(counts: list[tuple], rounds: int = 50) -> dict[tuple, float]:
    """Expectation-maximisation over counted vote patterns (votes, count) of one kind: the posterior of
    each pattern. Starts from the share of yes votes; a labeler that does not vote says nothing."""
    posterior = {}
    for pattern, _ in counts:
        cast = [v for v in pattern if v >= 0]
        posterior[pattern] = (sum(cast) + 0.5) / (len(cast) + 1)
    for _ in range(rounds):
        total = sum(n for _, n in counts)
        prior = (sum(n * posterior[p] for p, n in counts) + 1) / (total + 2)
        yes = []
        for j in range(len(LABELERS)):
            cast = [(p, n) for p, n in counts if p[j] >= 0]
            true = sum(n * posterior[p] for p, n in cast)
            false = sum(n * (1 - posterior[p]) for p, n in cast)
            hit = sum(n * posterior[p] for p, n in cast if p[j] == 1)
            miss = sum(n * (1 - posterior[p]) for p, n in cast if p[j] == 1)
            yes.append(((hit + 2) / (true + 3), (miss + 1) / (false + 3)))
        for p, _ in counts:
            odds = math.log(prior / (1 - prior))
            for v, (a, b) in zip(p, yes):
                if v >= 0:
                    odds += math.log(a / b) if v else math.log((1 - a) / (1 - b))
            posterior[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return posterior


def _features() -> Column:
    """What the classifier sees of a span, as bucket numbers."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("body", "[0-9]+", "9"), "[A-Za-z]+", "a"), "(?<=(.{24})).*$", "")
    cue = F.lit("")
    for k, words in CUES.items():
        cue = F.when(F.col("kind") == k, F.regexp_extract("before", f"(?i)({words})", 1)).otherwise(cue)

    def neighbour(c: Column) -> Column:
        kinds = F.when(c.rlike("[0-9]"), "9").when(c.rlike("\\p{L}"), "a").when(c.rlike("\\s"), " ")
        return kinds.otherwise(c)

    parts = {
        "shape": shape,
        "size": F.floor(F.length("body") / 4).cast("string"),
        "digits": F.least(F.length(_digits(F.col("body"))), F.lit(24)).cast("string"),
        "before": neighbour(F.right("before", F.lit(1))),
        "after": neighbour(F.left("after", F.lit(1))),
        "cue": F.lower(cue),
    }
    hashed = [F.pmod(F.xxhash64(F.lit(k), v), F.lit(FEATURE_BUCKETS)).cast("int") for k, v in parts.items()]
    return F.array(*hashed)


def judged(found: DataFrame) -> DataFrame:
    """The candidates with ``likely``, the posterior of their votes, and ``score``, the classifier's
    probability."""
    cast = found.withColumns(votes())
    # at most 3 votes of 5 labelers on 4 kinds
    counted = cast.groupBy("kind", *LABELERS).count().collect()
    rows = []
    for kind in KINDS:
        of_kind = [(tuple(r[j] for j in LABELERS), r["count"]) for r in counted if r.kind == kind]
        if of_kind:
            rows += [(kind, ",".join(map(str, p)), q) for p, q in reliabilities(of_kind).items()]
    soft = local_table(found.sparkSession, rows, "k string, pattern string, likely double")
    pattern = F.concat_ws(",", *LABELERS)
    known = cast.withColumn("votes", pattern).join(F.broadcast(soft), (F.col("kind") == F.col("k")) & (F.col("votes") == F.col("pattern")))
    known = known.select(*found.columns, "likely", F.array_distinct(_features()).alias("features"))
    listed = known.select("kind", "likely", F.explode("features").alias("feature"))
    weights = listed.groupBy("kind", "feature").agg(F.sum("likely").alias("yes"), F.sum(1 - F.col("likely")).alias("no"))
    totals = known.groupBy(F.col("kind").alias("k")).agg(F.sum("likely").alias("all_yes"), F.sum(1 - F.col("likely")).alias("all_no"))
    weights = weights.join(F.broadcast(totals), F.col("kind") == F.col("k")).select(
        "k", F.col("feature").alias("f"),
        F.log((F.col("yes") + 0.5) / (F.col("all_yes") + 1) * (F.col("all_no") + 1) / (F.col("no") + 0.5)).alias("weight"),
        F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)).alias("prior"),
    )
    # one row for each kind and bucket at most
    weights = F.broadcast(stored(weights, "span_weights"))
    span = ["doc_id", "doc_key", "source", "kind", "start", "stop", "base", "likely"]
    each = known.select(*span, F.explode("features").alias("feature"))
    each = each.join(weights, (F.col("kind") == F.col("k")) & (F.col("feature") == F.col("f")))
    summed = each.groupBy(*span).agg((F.sum("weight") + F.first("prior")).alias("odds"))
    return summed.withColumn("score", 1 / (1 + F.exp(-F.col("odds")))).drop("odds")


# ------------------------------------------------------------------ spans


def _written(spans: Column) -> Column:
    """kind:start:end of spans (start, number of the kind, end), joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"]))
    return F.array_join(each, ",")


def personal_data(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    keyed = slim(docs, text, id_column).withColumn("doc_key", text_key(F.col("text")))
    found = stored(candidates(keyed), "candidates")
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    span = F.struct(F.col("start"), number.alias("kind"), F.col("stop"))
    chosen = judged(found).withColumn("span", span)
    extra = ~F.col("base") & (F.col("likely") >= CERTAIN) & (F.col("score") >= CERTAIN)
    per_doc = chosen.filter(F.col("base") | extra).groupBy("doc_id", "doc_key").agg(
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("span")))).alias("base"),
        F.collect_set(F.when(extra, F.col("span"))).alias("extra"),
    )

    def apart(e: Column) -> Column:
        return ~F.exists("base", lambda b: (b["kind"] == e["kind"]) & (b["start"] < e["stop"]) & (e["start"] < b["stop"]))

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")

    per_doc = per_doc.withColumn("extra", F.filter("extra", apart))
    told = per_doc.select(
        "doc_id", "doc_key",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "extra"))).alias("spans"),
        F.size("extra").cast("bigint").alias("n_added"),
    )
    told = stored(told, "spans")
    rows = keyed.select("doc_id", "doc_key")
    joined = rows.join(told, same(rows, told, "doc_id", "doc_key"), "left").select(rows["doc_id"], *told.columns[2:])
    empty = {f"n_{k}": F.lit(0).cast("bigint") for k in (*KINDS, "added")} | {"base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit("")}
    return joined.select("doc_id", *[F.coalesce(c, empty[c]).alias(c) for c in told.columns[2:]])
