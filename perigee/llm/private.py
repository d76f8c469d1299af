"""Personal data, and terms that would give it away.

Emails, addresses, cards and phones are found by pattern. All terms of the texts that hold such a value are then
measured by what they disclose of it, counted over the different texts of the corpus: how likely the value is
where the term stands. The likelihood is the lower end of its confidence interval, so
few texts say little, and it hangs on the texts with the term only: texts that have neither change nothing, however many
they are. The value's own information says whether the two may have met by chance. Beyond one threshold terms are generalised to their class, beyond another removed. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.session import work_table

# The patterns give the same leftmost matches as their plain forms in the contract. Possessive repeats and the condition
# on what stands before (nothing of the kind, unless a match has just ended there) keep them from trying a long
# run of characters again from each of its places.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap conditions without which there is no valid match.
POSSIBLE = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": r"(?:[0-9][\x20-]?){12}[0-9]",
    "phone": r"\+[0-9]",
}
KINDS = (*PATTERNS, "term")
TERM = r"\p{L}{3,}"
#: Standard deviations between an estimated share and its lower bound. A term whose n texts all have the value
#: gets n / (n + 1): one text gives 0.5, four give 0.8; three texts of four 0.5, half of them never 0.5.
DEVIATIONS = 1.0
#: Lower bounds from which a term is generalised, and removed. They lie just below the values of one and of four texts.
GENERALISE = 0.48
REMOVE = 0.79
#: Bits of evidence that a term's texts do not hold the value by chance: each that does counts the value's own information.
#: One text is enough for a value that at most a 128th of all texts hold, two for a value of less than an eleventh.
LEAST_BITS = 7.0
#: Remainders of hashes by which rows are thinned out before a shuffle; there cannot be more values to broadcast.
THIN_VALUES = 1 << 20


def document_key() -> Column:
    """Rows with the same text are one document here: they get equal results, and copies count once."""
    return F.xxhash64("text")


def _pieces(text: Column, pattern: str) -> Column:
    return F.split(text, pattern, -1)


def _hits(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, pattern: str, kind: str) -> Column:
    """Matches with the number of code points between each and the one before."""
    pieces = _pieces(text, pattern)
    return F.transform(
        F.array(pieces),  # split once for all matches
        lambda p: F.transform(
            _hits(text, pattern),
            lambda hit, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("i"),
                F.char_length(F.get(p, i)).alias("gap"),
                hit.alias("value"),
            ),
        ),
    )[0]


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def weighed(i: Column) -> Column:
        digit = F.substr(turned, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda total, x: total + x) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.char_length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
        .when(kind == "card", F.when(size.between(13, 19), _luhn(digits)).otherwise(F.lit(False)))
        .otherwise(size.between(9, 15))
    )


def _spans(matches: DataFrame) -> DataFrame:
    """`matches` (key, kind, i, gap, value, ...) with start and end, code points, the end exclusive."""
    size = F.char_length("value")
    upto = F.sum(F.col("gap") + size).over(Window.partitionBy("key", "kind").orderBy("i"))
    return matches.withColumn("end", upto).withColumn("start", F.col("end") - size)


def find_values(docs: DataFrame) -> DataFrame:
    """Valid matches in the texts (doc_id, text): key (see `document_key`), kind, value, start, end."""
    text = F.col("text")
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,value:string>>")
    found = [
        F.when(text.rlike(POSSIBLE[kind]), _placed(text, pattern, kind)).otherwise(none)
        for kind, pattern in PATTERNS.items()
    ]
    matches = docs.select(document_key().alias("key"), F.inline(F.concat(*found)))
    # Only numbers between a kind's matches count for their places, so rows that are repeated are dropped first.
    placed = _spans(matches.dropDuplicates(["key", "kind", "i"]))
    return placed.filter(_valid(F.col("kind"), F.col("value"))).select("key", "kind", "value", "start", "end")


def lower_bound(hits: Column, of: Column) -> Column:
    """The lower end of the Wilson interval of hits / of."""
    share, z2 = hits / of, DEVIATIONS**2
    spread = F.sqrt(share * (1 - share) / of + z2 / (4 * of * of))
    return (share + z2 / (2 * of) - DEVIATIONS * spread) / (1 + z2 / of)


def term_class(term: Column) -> Column:
    """What a term is generalised to, by its writing: a name, a word in capitals, or a plain word."""
    return (
        F.when((F.upper(term) == term) & (F.lower(term) != term), "CAPITALS")
        .when(F.substr(term, F.lit(1), F.lit(1)) != F.lower(F.substr(term, F.lit(1), F.lit(1))), "NAME")
        .otherwise("WORD")
    )


def _thinned(rows: DataFrame, column: Column, wanted: DataFrame) -> DataFrame:
    """Rows whose `column` may be one of the only column of `wanted`, longs; none that is gets lost."""
    kept = F.pmod(F.col(wanted.columns[0]), F.lit(THIN_VALUES)).cast("int").alias("__thin")
    marked = rows.withColumn("__thin", F.pmod(column, F.lit(THIN_VALUES)).cast("int"))
    return marked.join(F.broadcast(wanted.select(kept).distinct()), "__thin", "left_semi").drop("__thin")


def _masked(text: Column) -> Column:
    """Text with what the patterns match replaced by as many noughts."""
    for pattern in PATTERNS.values():
        plain = text
        text = F.transform(
            F.array(F.struct(_pieces(plain, pattern).alias("p"), _hits(plain, pattern).alias("h"))),
            lambda x: F.array_join(
                F.transform(
                    x["p"],
                    lambda piece, i: F.concat(
                        piece, F.coalesce(F.repeat(F.lit("0"), F.char_length(F.get(x["h"], i))), F.lit(""))
                    ),
                ),
                "",
            ),
        )[0]
    return text


def term_tokens(docs: DataFrame, values: DataFrame) -> DataFrame:
    """key, term, class, start and end of all terms of the texts that hold values, without what the patterns match."""
    keys = values.select("key").distinct()
    keyed = docs.select(document_key().alias("key"), "text")
    texts = _thinned(keyed, F.col("key"), keys).join(keys, "key", "left_semi")
    # Dealt by rows: each becomes hundreds, so partitions that are packed by bytes would be few and long.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.repartition(shares, "key").dropDuplicates(["key"])
    texts = texts.select("key", _masked(F.col("text")).alias("text"))
    tokens = texts.select("key", F.inline(_placed(F.col("text"), TERM, "term"))).select("key", "kind", "i", "gap", "value")
    kind = term_class(F.col("value")).alias("class")
    return _spans(tokens).select("key", F.lower("value").alias("term"), kind, "start", "end")


def value_holders(values: DataFrame) -> DataFrame:
    """key, holders and with_value: the sets of texts that hold a value, by name and size, of each text.

    Values that the same texts hold have the same terms, so they are measured once, however many a text lists.
    """
    held = values.select("key", F.xxhash64("kind", F.lower("value")).alias("value")).distinct()
    sets = held.groupBy("value").agg(F.count("*").alias("with_value"), F.bit_xor(F.xxhash64("key")).alias("set"))
    sets = sets.select("value", "with_value", F.xxhash64("with_value", "set").alias("holders"))
    return held.join(sets, "value").select("key", "holders", "with_value").distinct()


def disclosing_terms(docs: DataFrame, values: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """key, term and `share`, the most that a value of the text is at least likely to be where the term is, from GENERALISE on.

    Counts are of different texts, and go over all of them: how many there are, how many have the value, the term,
    both. Every term of a text with a value is measured, from one text on. The number of all texts counts only for the
    evidence, so it decides nothing about values that at most a 128th of them hold. `tokens` is what `term_tokens` gives.
    """
    tokens = term_tokens(docs, values) if tokens is None else tokens
    held = tokens.select("key", "term").distinct().join(work_table(value_holders(values), "private-holders"), "key")
    together = held.groupBy("holders", "term", "with_value").agg(F.count("*").alias("both"))
    total = float(max(docs.select(document_key()).distinct().count(), 1))
    texts = docs.select(document_key().alias("key"), "text").dropDuplicates(["key"])
    words = texts.select(F.explode(F.array_distinct(F.transform(_hits(F.col("text"), TERM), F.lower))).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("with_term"))
    # Letters that touch a value can be a term only without it.
    measured = together.join(counts, "term", "left").withColumn("with_term", F.greatest("with_term", "both"))
    share = lower_bound(F.col("both").cast("double"), F.col("with_term").cast("double"))
    bits = F.col("both") * F.log2(F.lit(total) / F.col("with_value"))
    measured = measured.withColumn("share", share).filter((F.col("share") >= GENERALISE) & (bits >= LEAST_BITS))
    measured = measured.select("holders", "term", "share")
    flagged = work_table(measured, "private-flagged")
    return held.join(flagged, ["holders", "term"]).groupBy("key", "term").agg(F.max("share").alias("share"))


def find_terms(docs: DataFrame, values: DataFrame) -> DataFrame:
    """Spans of disclosing terms in the documents that hold the value they give away: key, kind, class, start, end, share."""
    tokens = work_table(term_tokens(docs, values), "private-tokens")
    wanted = work_table(disclosing_terms(docs, values, tokens), "private-wanted")
    pair = F.xxhash64("key", "term")
    return _thinned(tokens, pair, wanted.select(pair.alias("pair"))).join(wanted, ["key", "term"]).select("key", F.lit("term").alias("kind"), "class", "start", "end", "share")


def find_private(docs: DataFrame) -> DataFrame:
    """All spans: key (see `document_key`), kind, start, end and, for terms, share and class."""
    values = work_table(find_values(docs), "private-values")
    found = values.select("key", "kind", "start", "end")
    return found.unionByName(find_terms(docs, values), allowMissingColumns=True)


def sanitise(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text and any others) with values and disclosing terms replaced in their texts.

    Values become their kind in brackets, terms their class ([NAME], [CAPITALS], [WORD]), or nothing if they disclose too much. Overlapping spans
    are replaced as one, by the name of the first. A null text stays null; texts without spans stay as they are.
    """
    label = F.when(F.col("kind") != "term", F.concat(F.lit("["), F.upper("kind"), F.lit("]"))).otherwise(
        F.when(F.col("share") >= REMOVE, F.lit("")).otherwise(F.concat(F.lit("["), F.col("class"), F.lit("]")))
    )
    spans = find_private(docs).select("key", "start", "end", label.alias("label"))
    order = Window.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("reach", F.coalesce(reach, F.lit(0)))
    begins = F.sum(F.when(F.col("start") >= F.col("reach"), 1).otherwise(0)).over(order)
    merged = (
        spans.withColumn("run", begins)
        .groupBy("key", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("label", "start").alias("label"))
    )
    after = F.lag("end", 1, 0).over(Window.partitionBy("key").orderBy("start"))
    cuts = merged.withColumn("after", after).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "after", "label"))).alias("__cuts")
    )
    kept = F.transform("__cuts", lambda c: F.concat(F.substr("text", c["after"] + 1, c["start"] - c["after"]), c["label"]))
    rest = F.substr("text", F.element_at("__cuts", -1)["end"] + 1)
    text = F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), rest))
    joined = docs.withColumn("__key", document_key()).join(cuts.withColumnRenamed("key", "__key"), "__key", "left")
    return joined.select(*(text.alias(name) if name == "text" else F.col(f"`{name}`") for name in docs.columns))


def op6_private(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    spans = find_private(docs).groupBy("key").agg(
        *(F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in PATTERNS),
        F.array_sort(F.collect_list(F.struct(order.alias("order"), "start", "end", name.alias("name")))).alias("all"),
    )
    joined = F.array_join(F.transform("all", lambda x: x["name"]), ",")
    base = F.array_join(
        F.transform(F.filter("all", lambda x: x["order"] <= len(PATTERNS)), lambda x: x["name"]), ","
    )
    keyed = docs.select("doc_id", document_key().alias("key"))
    return keyed.join(spans, "key", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in PATTERNS),
        F.sha2(F.coalesce(base, F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined, F.lit("")).alias("spans"),
    )
