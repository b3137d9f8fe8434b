"""Sanitisation of personal data: patterns, and terms that reveal what the patterns found.

Patterns find e-mail addresses, network addresses, card and phone numbers. Each value found is a
protected entity. From the whole corpus follows how strongly a term of a document reveals an entity of the same
document. With n(e) documents with the entity, n(t) with the term and n(e, t) with both, wherever they stand,

    PMI(e; t) = log2(n(e, t) * N / (n(e) * n(t)))     disclosure = PMI(e; t) / -log2(n(e) / N)

Disclosure 1 means that the term gives the entity away completely, 0 that it says nothing. Most values stand in one or
two documents, too few to tell a revealing term from any rare word. A pair seen in fewer than ``LEAST_CONTEXTS`` different
surroundings of the term therefore counts with that share only; for the rest stands the disclosure, worked out alike, of the e-mail domain,
then of the kind of entity, and in the end 0. Copies and near copies, in which a term has the same surroundings, count once. Surroundings
are counted as the classes they meet in two divisions into 64, the larger of both numbers, so that counts of tasks merge: of two surroundings
one pair in 4,096 counts as one, of three one in 465 as two or one. Terms at or above the threshold are marked wherever they stand in documents with that entity. ``sanitised`` puts a tag in place of entities,
generalises a disclosing term to its initial and removes one that discloses completely.

Everything is DataFrame functions. Positions count code points from 0, the end is exclusive.

Defined results: a null text has no spans and stays null; an empty table gives an empty result. Repeated rows
are marked alike; ids are only used to carry terms back, so rows that share an id share their terms. Rows without
an id get pattern spans only. All other columns stay as they are in ``sanitised``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm.shared import counted, free_name, shuffled, staged

# Kinds and their patterns. Possessive quantifiers and the conditions on what stands before
# only keep the search linear; they find the same matches.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[\x20-]?+[0-9]){14})[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
_PLACE = {kind: i for i, kind in enumerate(KINDS)}

#: words on either side of a term that are its surroundings
CONTEXT_WORDS = 4
#: different surroundings of a term from which on a pair speaks for itself
LEAST_CONTEXTS = 3
#: surroundings are told apart in two divisions into this many classes, one bit each
_CLASSES = 64
#: share of an entity's information that a term may reveal
DISCLOSURE = 0.8
COMPLETE = 0.999

_BLOCK = 256
_SPAN = "array<struct<start:int,place:int,stop:int>>"


def _running(lengths: Column) -> Column:
    """Sum of the numbers before each element, in blocks so that long arrays stay cheap."""
    starts = F.when(F.size(lengths) > 0, F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))

    def before(values: Column, first: Column) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(values, begin, step, lambda acc: acc["out"])

    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(blocks, before(totals, F.lit(0)), before))


def _found(text: Column, pattern: Column, kind: str) -> Column:
    """Matches of a pattern: place, start, stop and value."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    # the text before each match and the match itself
    steps = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.length(p) + F.length(h))
    ends = F.zip_with(_running(steps), steps, lambda a, b: a + b)
    parts = F.arrays_zip(ends.alias("stop"), hits.alias("value"))

    def span(x: Column) -> Column:
        return F.struct((x["stop"] - F.length(x["value"])).alias("start"), F.lit(_PLACE[kind]).alias("place"), x["stop"].alias("stop"), x["value"].alias("value"))

    return F.transform(parts, span)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    places = F.split(F.reverse(_digits(value)), "")
    doubled = F.transform(F.filter(places, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _small_parts(value: Column) -> Column:
    plain = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(plain, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def base_spans(text: Column, values: bool = False) -> Column:
    """Entities by pattern as an array sorted by start, then kind."""
    empty = F.array().cast(_SPAN if not values else _SPAN[:-2] + ",value:string>>")

    def only(condition: Column, kind: str, pattern: str, valid=None) -> Column:
        found = _found(text, F.lit(pattern), kind)
        found = F.filter(found, lambda x: valid(x["value"])) if valid else found
        if not values:
            found = F.transform(found, lambda x: F.struct(x["start"], x["place"], x["stop"]))
        return F.when(condition, found).otherwise(empty)

    number = lambda v, low, high: F.length(_digits(v)).between(low, high)
    return F.array_sort(F.concat(
        only(F.contains(text, F.lit("@")), "email", EMAIL),
        only(F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), "ip", IP, _small_parts),
        only(F.rlike(text, F.lit(r"[0-9](?:[\x20-]?+[0-9]){13}")), "card", CARD, lambda v: number(v, 14, 19) & _luhn(v)),
        only(F.rlike(text, F.lit(r"\+[0-9]")), "phone", PHONE, lambda v: number(v, 10, 15)),
    ))


def _terms(words: Column) -> Column:
    """Runs of at least three letters in lower case, each once."""
    return F.array_distinct(F.regexp_extract_all(F.lower(words), F.lit(r"\p{L}{3,}"), F.lit(0)))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``found`` (entities with value) and, where there are any, ``near`` (each term outside e-mail addresses with the two
    classes of its surroundings, those with the smallest hash if it stands in several places) of every row; staged, without the texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), base_spans(text, values=True).alias("found"))
    outside = F.regexp_replace(F.lower(F.regexp_replace("text", EMAIL, " ")), r"[\x20\x09-\x0D]+", " ")
    rows = rows.select("doc_id", "found", F.when(F.size("found") > 0, F.split(outside, " ")).otherwise(F.array().cast("array<string>")).alias("words"))

    def around(word: Column, i: Column) -> Column:
        first = F.greatest(i + 1 - CONTEXT_WORDS, F.lit(1))
        context = F.xxhash64(F.slice(F.col("words"), first, i + 2 + CONTEXT_WORDS - first))
        return F.transform(_terms(word), lambda t: F.struct(t.alias("term"), context.alias("context")))

    rows = rows.select("doc_id", "found", F.sort_array(F.flatten(F.transform("words", around))).alias("places"))
    once = F.filter("places", lambda p, i: (i == 0) | (F.get("places", F.greatest(i - 1, F.lit(0)))["term"] != p["term"]))
    classes = F.transform(once, lambda p: F.struct(p["term"], F.pmod(p["context"], F.lit(_CLASSES**2)).cast("smallint").alias("context")))
    return staged(rows.select("doc_id", "found", classes.alias("near")), "mentions")


def _entity(m: Column) -> Column:
    return F.concat_ws(":", m["place"], m["value"])


def _wider(entity: Column) -> list[Column]:
    """The e-mail domain of an entity (null for other kinds) and its kind."""
    kind = F.substring_index(entity, ":", 1)
    return [F.when(kind == str(_PLACE["email"]), F.concat(F.lit("@"), F.lower(F.substring_index(entity, "@", -1)))), kind]


def disclosures(docs: DataFrame, found: DataFrame, text_col: str = "text", threshold: float = DISCLOSURE,
                least_contexts: int = LEAST_CONTEXTS) -> DataFrame:
    """``entity``, ``term``, ``disclosure`` of the terms that reveal an entity, from counts over all documents."""
    n = float(docs.count())
    own = F.transform("found", _entity)
    wider = F.filter(F.flatten(F.transform("found", lambda m: F.array(*_wider(_entity(m))))), lambda k: k.isNotNull())
    keyed = found.where("size(found) > 0").select(F.array_distinct(F.concat(own, wider)).alias("keys"), "near")
    n_e = staged(keyed.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n_e")), "entities")
    words = docs.select(F.explode(_terms(F.col(text_col))).alias("term"))
    n_t = staged(words.groupBy("term").agg(F.count("*").alias("n_t")), "frequencies")
    near = keyed.select("keys", F.explode("near").alias("x")).select("keys", "x.*")
    most = n_e.where(F.col("n_e") < n).agg(F.max("n_e")).first()[0]
    if most and threshold > 0:
        # terms so common that n(e, t) = min(n(e), n(t)) would not reach the threshold with any entity, domain or kind
        common = n_t.where(F.col("n_t") > n * (most / n) ** threshold * (1 + 1e-9)).select("term")
        near = near.join(counted(staged(common, "common")), "term", "left_anti")
    bits = [F.expr(f"bit_or(shiftleft(1L, CAST(context {part} {_CLASSES} AS INT)))") for part in ("%", "div")]
    pairs = near.select(F.explode("keys").alias("key"), "term", "context").groupBy("key", "term").agg(
        F.count("*").alias("n_et"), F.greatest(*map(F.bit_count, bits)).alias("contexts"))
    pairs = pairs.join(counted(n_e), "key").join(shuffled(n_t), "term")
    pmi = F.log2(F.col("n_et") * n / (F.col("n_e") * F.col("n_t")))
    # what all documents have says nothing
    score = F.when(F.col("n_e") < n, pmi / -F.log2(F.col("n_e") / n)).otherwise(F.lit(0.0))
    share = F.least(F.col("contexts") / least_contexts, F.lit(1.0))
    pairs = staged(pairs.select("key", "term", "n_e", score.alias("score"), share.alias("share")), "pairs")
    single = F.contains("key", F.lit(":"))
    rest = pairs.where(~single)
    domain, kind = [counted(staged(rest.where(is_domain).select(F.col("key").alias(c), "term", (F.col("score") * F.col("share")).alias(f"{c}_score"), F.col("share").alias(f"{c}_share")), c))
                    for c, is_domain in (("domain", F.col("key").startswith("@")), ("kind", ~F.col("key").startswith("@")))]
    # the disclosure of a wider key is 1 at most
    able = F.col("score") * F.col("share") + 1 - F.col("share") >= threshold - 1e-9
    own = pairs.where(single & (F.col("n_e") < n) & able).select("*", *[c.alias(k) for k, c in zip(("domain", "kind"), _wider(F.col("key")))])
    own = own.join(domain, ["domain", "term"], "left").join(kind, ["kind", "term"], "left")
    total, left = F.col("score") * F.col("share"), 1 - F.col("share")
    for c in ("domain", "kind"):
        total = total + left * F.coalesce(f"{c}_score", F.lit(0.0))
        left = left * (1 - F.coalesce(f"{c}_share", F.lit(0.0)))
    scored = own.select(F.col("key").alias("entity"), "term", total.alias("disclosure"))
    return staged(scored.where(F.col("disclosure") >= threshold), "disclosures")


def revealing(found: DataFrame, disclosing: DataFrame) -> DataFrame:
    """``doc_id`` and ``terms`` (term to its disclosure) that reveal an entity of that document."""
    held = found.where("size(found) > 0 and doc_id is not null").select("doc_id", F.explode("found").alias("m")).select(
        "doc_id", _entity(F.col("m")).alias("entity")).distinct()
    terms = held.join(counted(disclosing), "entity").groupBy("doc_id", "term").agg(F.max("disclosure").alias("disclosure"))
    return staged(terms.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("term", "disclosure"))).alias("terms")), "revealing")


def _term_spans(text: Column, terms: Column) -> Column:
    """Where terms stand as whole runs of letters, in any case."""
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.transform(terms, lambda t: t["term"]), "|"), F.lit(r")(?!\p{L})"))
    return _found(text, pattern, "term")


def _with_terms(docs: DataFrame, id_col: str, text_col: str, threshold: float, least_contexts: int) -> tuple[DataFrame, DataFrame]:
    found = mentions(docs, id_col, text_col)
    return found, revealing(found, disclosures(docs, found, text_col, threshold, least_contexts))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of all spans, by comma."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["place"] + 1), s["start"], s["stop"])), ",")


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["stop"].alias("stop")))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = DISCLOSURE,
          least_contexts: int = LEAST_CONTEXTS) -> DataFrame:
    """``doc_id``, ``base`` (pattern spans) and ``all_spans`` (with terms) of every row.

    Texts are read again only to place terms; they are not shuffled unless very many documents have such terms.
    """
    found, terms = _with_terms(docs, id_col, text_col, threshold, least_contexts)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(counted(terms, items="terms"), "doc_id")
    added = texts.select("doc_id", _bare(_term_spans(F.col("text"), F.col("terms"))).alias("added")).groupBy("doc_id", F.xxhash64("added")).agg(F.first("added").alias("added"))
    added = staged(added.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("added"))).alias("added")), "added")
    whole = found.join(counted(added, items="added"), "doc_id", "left")
    base = _bare(F.col("found"))
    every = F.array_sort(F.concat(base, F.coalesce("added", F.array().cast(_SPAN))))
    return whole.select("doc_id", base.alias("base"), every.alias("all_spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = DISCLOSURE,
              least_contexts: int = LEAST_CONTEXTS) -> DataFrame:
    """The rows with their text sanitised: ``<email>`` and so on for entities, an initial for terms, nothing for
    terms that disclose completely. Overlapping entities get one tag, that of the first."""
    _, terms = _with_terms(docs, id_col, text_col, threshold, least_contexts)
    keyed = terms.select(F.col("doc_id").alias("_key"), F.col("terms").alias("_terms"))
    row = free_name(docs, "row")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(row)).join(counted(keyed, items="_terms"), F.col(f"{row}.`{id_col}`") == F.col("_key"), "left")
    text = F.col(f"{row}.`{text_col}`")
    complete = F.transform(F.filter("_terms", lambda t: t["disclosure"] >= COMPLETE), lambda t: t["term"])
    marked = F.concat(
        F.transform(base_spans(text), lambda s: F.struct(s["start"], s["stop"], F.concat(F.lit("<"), F.element_at(F.array(*map(F.lit, KINDS)), s["place"] + 1), F.lit(">")).alias("by"))),
        F.when(F.col("_terms").isNotNull(), F.transform(_term_spans(text, F.col("_terms")), lambda s: F.struct(
            s["start"], s["stop"], F.when(F.array_contains(complete, F.lower(s["value"])), "").otherwise(F.concat(F.substring(s["value"], 1, 1), F.lit("."))).alias("by"),
        ))).otherwise(F.array().cast("array<struct<start:int,stop:int,by:string>>")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(s["stop"].alias("at"), F.concat(acc["out"], F.array(kept, s["by"])).alias("out")))

    clean = F.aggregate(F.array_sort(marked), begin, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1)))
    # texts without a span are passed on as they are
    clean = F.when(F.size(marked) > 0, clean).otherwise(text)
    # in two steps: within one, the rows' own columns could stand in for those named here
    out = rows.select(F.col(row), clean.alias("_clean"))
    return out.select(*[F.col("_clean").alias(c) if c == text_col else F.col(f"{row}.`{c}`") for c in docs.columns])
