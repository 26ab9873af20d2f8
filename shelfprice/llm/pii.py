"""Personal data, found by patterns and by what the corpus says about the words around it.

Patterns find emails, addresses of machines, card and phone numbers; each value is a protected entity. A word of a
document with an entity discloses it if the corpus shows that the word tells nearly as much about the entity as its
name does: PMI(entity; word) = log p(entity, word) / (p(entity) p(word)) reaches ``alpha`` times the entity's information
-log p(entity). All three are shares of the distinct texts, so that copies neither prove nor hide anything; the joint
count is shrunk by a discount, as few texts prove little. Wherever such a word stands in a document with its entity, it
is a span too. In the text, values are generalised to their kind and disclosing words are removed. Everything is a
column expression or a join; no Python runs in tasks.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfprice.llm.blocks import document_digest
from shelfprice.sources.staging import TEXTS_A_FILE, in_few_files, write_through

KINDS = ["email", "ip", "card", "phone"]

#: The patterns of the contract, written so that no start is tried twice within a run and nothing is given back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{N}_]{3,}"
#: Of the joint count. One text never discloses (below 10**9 texts), two that hold a word and an entity do from 7,000 on.
DISCOUNT = 2 / 3
_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the sum of all digits of the results is a multiple of 10."""
    figures = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    added = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(added, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return value.isNotNull()
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= F.when(F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255", 3).otherwise(2))
    if kind == "card":
        return _luhn(_digits(value))
    return F.length(_digits(value)).between(8, 15)


def _canonical(kind: str, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value))


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _run_up(values: Column, total) -> Column:
    """For each entry, ``total`` of all entries before it, in steps of 128 so that the work is not that of all pairs."""
    step, shift = 128, 7

    def along(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(v), shift)), lambda c: total(F.slice(v, c * step + 1, F.lit(step))))
        ahead = lambda p: F.transform(p, lambda _, c: total(F.slice(p, F.lit(1), c)))
        return _let(parts, lambda p: _let(ahead(p), lambda q: F.transform(v, lambda _, i: total(F.array(F.get(q, F.shiftright(i, shift)), total(F.slice(v, F.shiftright(i, shift) * step + 1, i % step)))))))

    return _let(values, along)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _largest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0))


def _located(text: Column, pattern: str, kind: str, valid, value) -> Column:
    """The valid matches of a pattern with their places in code points, end exclusive.

    What lies between matches and the matches themselves alternate; their lengths add up to the places.
    """
    pattern = F.lit(pattern)
    zipped = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)), lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("found")))

    def spans(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda x: x["gap"] + F.coalesce(F.length(x["found"]), F.lit(0)))

        def span(x: Column, before: Column) -> Column:
            start = before + x["gap"]
            at = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(x["found"])).alias("end"), value(x["found"]).alias("value"))
            return F.when(x["found"].isNotNull() & valid(x["found"]), at)

        return F.filter(F.zip_with(pairs, _run_up(lengths, _sum), span), lambda x: x.isNotNull())

    none = F.array().cast(_SPANS)
    return F.when(F.rlike(text, pattern), _let(zipped, spans)).otherwise(none)


def base_spans(text: Column) -> Column:
    """All pattern spans of a text, by kind and start."""
    return F.concat(*(_located(text, PATTERNS[k], k, partial(_valid, k), partial(_canonical, k)) for k in KINDS))


def _held(found: DataFrame) -> DataFrame:
    """(content, entity)"""
    return found.select("content", F.explode(F.transform("spans", lambda s: s["value"])).alias("entity")).distinct()


def _disclosing(found: DataFrame, docs: DataFrame, alpha: float) -> tuple[DataFrame, DataFrame]:
    """(content, held) of texts with entities, by the set of these; (held, term): the words that disclose one of a set.

    ``docs`` has the content and text of all documents.

    A word discloses if (n_pair - DISCOUNT) / n_term, the share of its texts that have the entity, reaches p(entity) to
    the power 1 - alpha, which is the rule on PMI. As n_pair is at most n_term and n_entity, that leaves out entities in
    too few texts, and words in too few or too many, before any pair is made. Words are counted by the set of such
    entities that their text has, so that a common entity makes no row for each text; sets travel by their digests. The
    words of an entity are never gathered: a text is joined with those that it holds itself.
    """
    distinct = found.groupBy("content").agg(F.max(F.size("spans")).alias("n"))
    contents, n_held = distinct.agg(F.greatest(F.count("*"), F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    least = F.pow(F.col("n_entity") / F.lit(float(contents)), 1 - alpha)
    pairs_held = _held(found)
    entities = pairs_held.groupBy("entity").agg(F.count("*").alias("n_entity")).withColumn("least", least)
    entities = entities.filter((F.col("n_entity") - DISCOUNT) / F.col("n_entity") >= F.col("least"))
    entities = entities.select("entity", "least", F.floor(F.col("n_entity") / F.col("least")).alias("most_texts"), F.ceil(F.lit(DISCOUNT) / (1 - F.col("least"))).alias("least_texts"))
    entities = write_through(entities, "pii-entities", n_held)
    gathered = pairs_held.join(entities.select("entity"), "entity").groupBy("content").agg(F.sort_array(F.collect_set("entity")).alias("entities"))
    holders = write_through(gathered.select("content", F.md5(F.to_json("entities").cast("binary")).alias("held"), "entities"), "pii-holders", n_held)
    sets = holders.dropDuplicates(["held"]).select("held", F.explode("entities").alias("entity"))

    texts = docs.dropDuplicates(["content"]).join(holders.select("content", "held"), "content", "left")
    words = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))
    counted = texts.select("held", F.explode(words).alias("term")).groupBy("term", "held").agg(F.count("*").alias("n"))
    counted = write_through(counted, "pii-words")

    bounds = entities.agg(F.min("least_texts").alias("low"), F.max("most_texts").alias("high")).first()
    terms = counted.groupBy("term").agg(F.sum("n").alias("n_term"), F.max(F.col("held").isNotNull()).alias("beside"))
    terms = terms.filter(F.col("beside") & F.col("n_term").between(F.lit(bounds["low"]), F.lit(bounds["high"]))).select("term", "n_term")
    beside = counted.filter("held is not null").join(terms, "term").join(sets, "held")
    beside = write_through(beside.select("held", "term", "n_term", "n", "entity"), "pii-beside", counted.count())
    pairs = beside.groupBy("entity", "term").agg(F.sum("n").alias("n_pair"), F.first("n_term").alias("n_term")).join(entities, "entity")
    told = pairs.filter((F.col("n_pair") - DISCOUNT) / F.col("n_term") >= F.col("least")).select("entity", "term")
    told = write_through(beside.join(told, ["entity", "term"]).select("held", "term").distinct(), "pii-told", beside.count())
    return holders.select("content", "held"), told


def _marked(found: DataFrame, holders: DataFrame, told: DataFrame) -> DataFrame:
    """(content, terms): every occurrence of a disclosing word that neither lies in a span of its text nor touches one.

    Of the spans that start up to a word's end, the one that ends last tells; a text's words and spans are swept together.
    """
    texts = found.filter(F.size("spans") > 0).dropDuplicates(["content"]).join(holders, "content").join(told.select("held").distinct(), "held", "left_semi")
    places = _located(F.col("body"), TERM, "term", lambda v: F.lit(True), lambda v: F.lower(v))
    words = texts.select("content", "held", F.explode(places).alias("w")).select("content", "held", F.col("w.value").alias("term"), "w.start", "w.end")
    words = words.join(told, ["held", "term"]).select("content", F.col("end").alias("at"), F.lit(1).alias("turn"), "start", "end", "term")
    spans = texts.select("content", F.explode("spans").alias("s"))
    spans = spans.select("content", F.col("s.start").alias("at"), F.lit(0).alias("turn"), "s.start", "s.end", F.lit(None).cast("string").alias("term"))
    so_far = Window.partitionBy("content").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.max(F.when(F.col("turn") == 0, F.col("end"))).over(so_far)
    outside = words.unionByName(spans).withColumn("reached", reached).filter((F.col("turn") == 1) & (F.coalesce("reached", F.lit(-1)) < F.col("start")))
    span = F.struct(F.col("start"), F.col("end"), F.col("term"))
    ordered = F.transform(F.sort_array(F.collect_list(span)), lambda x: F.struct(F.lit("term").alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["term"].alias("value")))
    return outside.groupBy("content").agg(ordered.alias("terms"))


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.select("doc_id", document_digest(F.col("doc_id"), F.col("text")).alias("doc"), F.md5(F.col("text").cast("binary")).alias("content"), "text")


def _found(docs: DataFrame, doc_id: str, text: str, alpha: float) -> tuple[DataFrame, int]:
    """(doc_id, doc, spans, terms) of every document, and their number; terms are null where there are none."""
    own = _texts(docs, doc_id, text)
    based = own.select("doc_id", "doc", "content", base_spans(F.col("text")).alias("spans"), "text")
    found = write_through(based.select("doc_id", "doc", "content", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("body")), "pii-base")
    holders, told = _disclosing(found, own.select("content", "text"), alpha)
    marked = write_through(_marked(found, holders, told), "pii-marked")
    return found.select("doc_id", "doc", "content", "spans").join(marked, "content", "left").select("doc_id", "doc", "spans", "terms"), found.count()


def _all(terms: Column, spans: Column) -> Column:
    return F.concat(spans, F.coalesce(terms, F.array().cast(_SPANS)))


def find_personal_data(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", alpha: float = 0.95) -> DataFrame:
    """Per document: (doc_id, doc, spans); ``spans`` holds kind, start, end (code points, end exclusive) and value.

    Kinds are email, ip, card and phone, which are protected entities, and term: a word that discloses an entity of its
    document, wherever it stands there outside the values. Words count in lower case, from three letters or digits on,
    once in each distinct text. ``doc`` is a digest of id and text.

    A null text is empty. Rows with a null or repeated id are documents of their own. Further columns are ignored. An
    empty table gives none.
    """
    found, _ = _found(docs, doc_id, text, alpha)
    return found.select("doc_id", "doc", _all(F.col("terms"), F.col("spans")).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: the number of spans of each base kind, the digest of the base spans, and all spans as text."""
    found = find_personal_data(docs, **options)
    base = F.filter("spans", lambda s: s["kind"] != "term")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with its values generalised to their kind (``<EMAIL>``) and its disclosing words removed.

    A span that begins within earlier ones is left out. Texts are taken apart in pieces of 1024 code points, so that what
    lies between two spans is found without going through the text from its start.
    """
    size, shift = 1024, 10

    def whole(parts: Column) -> Column:
        def between(a: Column, b: Column) -> Column:
            held = F.array_join(F.slice(parts, F.shiftright(a, shift) + 1, F.shiftright(b, shift) - F.shiftright(a, shift) + 1), "")
            return F.when(b > a, F.substr(held, a % size + 1, b - a)).otherwise(F.lit(""))

        def cut(ordered: Column) -> Column:
            def one(s: Column, reached: Column) -> Column:
                put = F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
                return F.when(s["start"] >= reached, F.concat(between(reached, s["start"]), put)).otherwise(F.lit(""))

            ends = F.transform(ordered, lambda s: s["end"])
            rest = between(_largest(ends), F.length(text))
            return F.concat(F.array_join(F.zip_with(ordered, _run_up(ends, _largest), one), ""), rest)

        return _let(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))), cut)

    return F.when(F.size(spans) > 0, _let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{size}}}"), F.lit(0)), whole)).otherwise(text)


def redact(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", alpha: float = 0.95) -> DataFrame:
    """The documents, all columns as they are but for the text; see find_personal_data. A null text stays null."""
    found, n_docs = _found(docs, doc_id, text, alpha)
    found = found.filter(F.size("spans") > 0).select("doc", _all(F.col("terms"), F.col("spans")).alias("spans")).dropDuplicates(["doc"])
    row = F.col("row")
    whole = docs.select(F.struct("*").alias("row")).withColumn("doc", document_digest(row[doc_id].cast("long"), F.coalesce(row[text], F.lit(""))))
    clean = F.when(F.col("spans").isNull(), row[text]).otherwise(redacted(row[text], F.col("spans")))
    return in_few_files(whole.join(found, "doc", "left").select(*[clean.alias(c) if c == text else row[c].alias(c) for c in docs.columns]), n_docs, TEXTS_A_FILE)
