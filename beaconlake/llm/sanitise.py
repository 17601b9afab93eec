"""Information-theoretic sanitisation: personal data, and the terms that give it away.

Personal data (e-mail, IP address, card and phone numbers) is found by fixed patterns, leftmost first and without
overlaps per kind. Each distinct value is a protected entity c. A term t is any word of a text that holds c; a word is a
run of letters, marks and digits. With counts of distinct texts (by SHA-256, so copies count once) over the whole corpus,

    disclosure(t, c) = log(p(t, c) / (p(t) p(c))) / -log p(c)

is the share of what there is to know about c that t tells: 0 for words that occur everywhere, 1 for a word that
occurs with c only. Estimates from few sightings are too high, so p(t, c) is discounted absolutely: `DISCOUNT` is taken
off its count. No entity or term is left out for being rare: one sighting of a word that occurs nowhere else tells
1 - log(4) / log(n) of an entity mentioned once, two tell 1 - log(1.6) / log(n / 2). A term whose disclosure of any
entity reaches `GENERALISED` is marked wherever it stands, with or without the entity: it is generalised to its first
letter, or removed if the disclosure reaches `REMOVED`. With `small_words`, as in the query, that holds for every word;
without, words of one or two small letters are not marked; such words with a capital are.

A null text is empty. Rows that repeat are documents of their own. No documents give no rows. Spans are in code points,
end exclusive. A term within personal data is part of that and no span of its own.

Everything is DataFrame expressions. The patterns are written so that the time for a text grows with its length:
a match begins at the start of a run or where the last match ended, and runs are taken whole. They match what the
plain forms beside them match.

Scale: texts are scanned where they lie. Documents are counted for every word, in each task before the shuffle. Entities
that stand in the same texts tell the same, so one of them speaks for all; pairs are counted in each task before the
shuffle, too. The `FREQUENT` most frequent words are looked up in a table that is broadcast by hint: pairs and
occurrences of those that cannot or do not disclose are left out before a shuffle, which changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.session import staged

DISCOUNT = 0.75
GENERALISED = 0.8
REMOVED = 0.95
FREQUENT = 1 << 16
BLOCK = 32  # words whose places are added up together
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]++"
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}(?:\.{_LABEL})++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_WORD = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*+"
_SMALL = r"^\p{Ll}{1,2}$"


def _hint(kind: str) -> Column:
    """A cheap test that a text can have a match."""
    text = F.col("text")
    return F.contains(text, F.lit({"email": "@", "phone": "+"}[kind])) if kind in ("email", "phone") else text.rlike("[0-9]")


def _parted(text: Column, pattern: str) -> Column:
    """Matches of a pattern, each with the text between it and the one before. Both lists are made once per text."""
    lead, value = F.split(text, pattern, -1).alias("lead"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")
    return F.filter(F.arrays_zip(lead, value), lambda p: p["value"].isNotNull())


def _found(kind: str) -> Column:
    """Matches of a text in order, each with the number of characters between it and the one before."""
    pairs = _parted(F.col("text"), PATTERNS[kind])
    each = F.transform(pairs, lambda p, i: F.struct(i.alias("i"), F.length(p["lead"]).alias("lead"), p["value"].alias("value")))
    return F.when(_hint(kind), each).otherwise(F.array().cast("array<struct<i: int, lead: int, value: string>>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum of up to 20 digits."""
    padded = F.lpad(digits, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    terms = [F.substring(doubled if i % 2 else padded, i, 1).cast("int") for i in range(1, 21)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total % 10 == 0


def base_spans(rows: DataFrame) -> DataFrame:
    """(row, kind, value, start, end) of the personal data in rows with `found`, an array per kind."""
    parts = None
    for kind in PATTERNS:
        one = rows.where(F.size(F.col(f"found_{kind}")) > 0).select("row", F.lit(kind).alias("kind"), F.explode(f"found_{kind}").alias("m")).select("row", "kind", "m.*")
        parts = one if parts is None else parts.unionByName(one)
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("lead") + F.length("value")).over(before)
    spans = parts.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    digits = _digits(F.col("value"))
    valid = (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", F.col("value").rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(F.col("kind") == "card", F.length(digits).between(13, 19) & _luhn(digits))
        .otherwise(F.length(digits).between(9, 15))
    )
    return spans.where(valid).select("row", "kind", "value", F.col("start").cast("long"), F.col("end").cast("long"))


def _may_hold() -> Column:
    """A cheap test on `found` that a text can have personal data: matches too short for enough digits do not count."""

    def held(kind: str, least: int) -> Column:
        return F.exists(f"found_{kind}", lambda m: F.length(m["value"]) >= least)

    return held("email", 1) | held("ip", 1) | held("card", 13) | held("phone", 10)


def _words(text: Column) -> Column:
    """The words of a text in lower case, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower))


def _entities(mentions: DataFrame) -> DataFrame:
    """(row, entity, mentions) of the texts of each entity; of entities that stand in the same texts, one speaks for all."""
    held = staged(mentions.select("row", "entity").distinct(), "mentions")
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("row"))).alias(f"mark{seed}") for seed in (1, 2)]
    sizes = held.groupBy("entity").agg(F.count(F.lit(1)).alias("mentions"), *marks)
    speakers = staged(sizes.groupBy("mentions", "mark1", "mark2").agg(F.min("entity").alias("entity")).select("entity", "mentions"), "entities")
    return held.join(speakers, "entity").select("row", "entity", "mentions")


def _frequent(held: DataFrame) -> DataFrame:
    """The most frequent terms, `FREQUENT` at most: those above the lowest of finely stepped counts that leaves no more."""
    step = F.floor(F.log2("documents") * 8).cast("int")
    cut, room = 1 << 10, FREQUENT
    steps = held.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("terms")).collect()  # 512 rows at most
    for at, terms in sorted(map(tuple, steps), reverse=True):
        if terms > room:
            break
        cut, room = at, room - terms
    return held.where(step >= cut)


def disclosing_terms(
    texts: DataFrame, mentions: DataFrame, held: DataFrame, frequent: DataFrame, total: int, discount: float, threshold: float
) -> DataFrame:
    """(term, disclosure) of the terms that tell at least `threshold` of an entity: the most they tell of any."""
    n = F.lit(float(total))

    def disclosure(both: Column, documents: Column) -> Column:
        told = F.log((both - discount) * n / (documents * F.col("mentions"))) / F.log(n / F.col("mentions"))
        return F.when(F.col("mentions") < total, told).otherwise(0.0)

    of_row = _entities(mentions).groupBy("row").agg(F.collect_list(F.struct("entity", "mentions")).alias("entities"))
    words = texts.join(of_row, "row").select("entities", F.explode(_words(F.col("text"))).alias("term"))
    # What a term can tell at most: it stands with the entity wherever it or the entity stands.
    words = words.join(F.broadcast(frequent.select("term", F.col("documents").alias("known"))), "term", "left")
    pairs = words.select("term", "known", F.explode("entities").alias("e")).select("term", "known", "e.*")
    most = disclosure(F.least("known", "mentions"), F.col("known"))
    pairs = pairs.where(F.col("known").isNull() | (most >= threshold - 1e-9))
    pairs = pairs.groupBy("term", "entity", "mentions").agg(F.count(F.lit(1)).alias("both"))
    pairs = staged(pairs.where(disclosure(F.col("both"), F.col("both")) >= threshold - 1e-9), "pairs")
    known = pairs.join(held, "term").withColumn("disclosure", disclosure(F.col("both"), F.col("documents")))
    return known.where(F.col("disclosure") >= threshold).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def _placed(text: Column) -> Column:
    """The words of a text with their places: `array<struct<word: struct<lead, value>, start: int>>`.

    Places are added up in blocks of `BLOCK` words, as appending to an array copies it. Nothing else is done to a word
    here: rows are cheaper to work on than elements of an array.
    """
    none = "array<int>"

    def starts(words: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / BLOCK).cast("int"))
        first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{none}>").alias("blocks"))

        def one(state: Column, w: Column) -> Column:
            begin = state["at"] + F.length(w["lead"])
            return F.struct((begin + F.length(w["value"])).alias("at"), F.array_append(state["starts"], begin).alias("starts"))

        def block(state: Column, number: Column) -> Column:
            part = F.slice(words, number * BLOCK + 1, F.lit(BLOCK))
            done = F.aggregate(part, F.struct(state["at"].alias("at"), F.array().cast(none).alias("starts")), one)
            # The one-element array keeps the block from being made again for each use.
            return F.element_at(
                F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.array_append(state["blocks"], d["starts"]).alias("blocks"))), 1
            )

        return F.flatten(F.aggregate(numbers, first, block, lambda state: state["blocks"]))

    def placed(words: Column) -> Column:
        return F.when(F.size(words) > 0, F.arrays_zip(words.alias("word"), starts(words).alias("start")))

    return F.element_at(F.transform(F.array(_parted(text, _WORD)), placed), 1)


def _occurrences(texts: DataFrame, telling: DataFrame, frequent: DataFrame, small_words: bool) -> DataFrame:
    """(row, term, disclosure, start, end): every place of the disclosing terms in the texts."""
    silent = staged(frequent.select("term").join(telling, "term", "left_anti"), "silent")
    held = texts.select("row", F.explode(_placed(F.col("text"))).alias("w")).select(
        "row", F.col("w")["word"]["value"].alias("value"), F.col("w")["start"].cast("long").alias("start")
    )
    words = held.select("row", "value", F.lower("value").alias("term"), "start", (F.col("start") + F.length("value")).alias("end"))
    words = words.join(F.broadcast(silent), "term", "left_anti")
    if not small_words:
        words = words.where(~F.col("value").rlike(_SMALL))
    return words.drop("value").join(telling, "term").select("row", "term", "disclosure", "start", "end")


def _apart(places: DataFrame, base: DataFrame) -> DataFrame:
    """The places that share no character with personal data."""
    none = F.lit(None)
    events = places.select("*", (F.col("end") - 1).alias("at"), none.cast("long").alias("covered")).unionByName(
        base.select("row", F.col("start").alias("at"), F.col("end").alias("covered")), allowMissingColumns=True
    )
    until = F.max("covered").over(Window.partitionBy("row").orderBy("at"))
    return events.withColumn("until", until).where(F.col("term").isNotNull() & (F.coalesce("until", F.lit(0)) <= F.col("start")))


def find(
    docs: DataFrame, discount: float = DISCOUNT, generalised: float = GENERALISED, removed: float = REMOVED,
    id_col: str = "doc_id", text_col: str = "text", small_words: bool = False,
) -> DataFrame:
    """(doc_id, spans, text): spans of kind, start, end and replacement by kind and start; `text` is null without spans.

    `small_words` marks disclosing words of one or two small letters, too.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", digest, *[_found(k).alias(f"found_{k}") for k in PATTERNS])
    rows = staged(rows, "personal", compression="zstd")
    firsts = staged(rows.groupBy("digest").agg(F.min("row").alias("row")), "firsts")
    copies = staged(rows.select("row").join(firsts, "row", "left_anti"), "copies")
    once = rows.join(copies, "row", "left_anti")
    base = staged(base_spans(once), "base-spans")

    entity = F.concat_ws(":", "kind", F.when(F.col("kind").isin("card", "phone"), _digits(F.col("value"))).otherwise(F.lower("value")))
    held = staged(once.select(F.explode(_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("documents")), "terms")
    frequent = staged(_frequent(held), "frequent")
    mentions = base.select("row", entity.alias("entity"))
    holding = once.where(_may_hold()).select("row", "text")
    telling = staged(disclosing_terms(holding, mentions, held, frequent, firsts.count(), discount, generalised), "telling")
    apart = _apart(_occurrences(once.select("row", "text"), telling, frequent, small_words), base)
    shown = F.when(F.col("disclosure") >= removed, "").otherwise(F.concat(F.substring("term", 1, 1), F.lit("*")))
    spans = base.select("row", "kind", "start", "end", F.concat(F.lit("["), F.upper("kind"), F.lit("]")).alias("replacement")).unionByName(
        apart.select("row", F.lit("term").alias("kind"), "start", "end", shown.alias("replacement"))
    )
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    listed = F.array_sort(F.collect_list(F.struct(order.alias("order"), "start", "end", "kind", "replacement")))
    of_text = staged(spans.groupBy("row").agg(listed.alias("spans")).join(firsts, "row").select("digest", "spans"), "spans")
    out = rows.select("doc_id", "text", "digest").join(of_text, "digest", "left")
    none = F.array().cast("array<struct<order: int, start: bigint, end: bigint, kind: string, replacement: string>>")
    return out.select("doc_id", F.coalesce("spans", none).alias("spans"), F.when(F.col("spans").isNotNull(), F.col("text")).alias("text"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span replaced; where spans overlap, the first one counts and the rest is left out."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["replacement"].alias("r"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("done"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        shown = F.when(s["start"] >= state["at"], s["r"]).otherwise("")
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.array_append(state["done"], F.concat(between, shown)).alias("done"))

    def whole(state: Column) -> Column:
        return F.concat(F.array_join(state["done"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    return F.aggregate(ordered, start, step, whole)
