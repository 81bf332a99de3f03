"""Line dedup by a log-template tree, with DataFrame functions only.

A line is parsed at fixed depth: its number of tokens, then its first
``LEADING`` tokens, name a leaf.  Tokens with a digit are variable fields from
the start.  Within a leaf that several families of documents reach, a token is
constant at a position where lines of at least ``MIN_FAMILIES`` families have
it, and any other is variable.  Lines that agree in their constant tokens have
one form; a form with at least ``CONSTANT`` of its positions constant is a
template, so a leaf holds as many templates as it has such forms.

A line recurs by itself (with its variable fields masked) or as a line of its
template.  Its documents are judged without the lines of its own leaf, by their
main lines: the longest line of each other leaf, longest first, up to
``MAIN_LINES`` of them, each known by its first tokens.  The line is dropped,
everywhere, if it recurs

* in at least ``MIN_FAMILIES`` families, where a family shares the first main
  line, and in at least half as many families as different documents, or
* in at least ``MIN_FAMILIES`` families, where a document with ``OWN_LINES``
  main lines or more is a family if it shares none of them with another of the
  documents, and all the others are one.

So boilerplate goes, also where a large group of copies holds it or where it is
the longest line itself, while the lines of copied documents, which come with
the same main lines, are left to near-duplicate removal: an edited copy would
have to differ in the first tokens of all its main lines to count as another
family.  Documents with nothing but lines of one leaf are one family.

Lines are split at line feeds, tokens at white space.  Blank lines stay.  Null
texts stay null.  Repeated rows count as one document and are cleaned alike;
null ids don't matter, as documents are known by their text.  Empty tables give
an empty result.  Extra columns stay in ``without_templates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import prepare, stored

LEADING = 3
CONSTANT = 0.7
MIN_FAMILIES = 3
#: main lines by which a document is known, and how many it needs to count by itself
MAIN_LINES = 5
OWN_LINES = 3
FIELD = "<*>"
#: a whole token that holds a digit; possessive, so that long tokens are read once
VARIABLE = r"(?<![^\x09-\x0D\x20])[^\x09-\x0D\x200-9]*+[0-9][^\x09-\x0D\x20]*+"
SPACE = r"[\x09-\x0D\x20]+"


def masked(line: Column) -> Column:
    """The tokens of a line between single spaces, variable fields replaced.

    Most lines hold neither digits nor odd white space; quick looks spare them
    the replacements."""
    fields = F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, FIELD)).otherwise(line)
    odd = F.contains(line, F.lit("  ")) | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" ")) | line.rlike(r"[\x09-\x0D]")
    return F.when(odd, F.trim(F.regexp_replace(fields, SPACE, " "))).otherwise(fields)


def leading(line: Column) -> Column:
    return F.substring_index(line, " ", LEADING)


def leaf_of(line: Column) -> Column:
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.xxhash64(spaces, leading(line))


def fenced(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` through a one-row generator, so that later steps read it instead of evaluating it again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc (hash of the text), key, leaf, line (masked), mains of every distinct line that isn't blank."""
    d = docs.select("text").where("text is not null").select(F.xxhash64("text").alias("doc"), F.split("text", "\n").alias("lines"))
    d = fenced(d, "plain", F.array_distinct(F.filter(F.transform("lines", masked), lambda line: line != ""))).select("doc", "plain")
    # by leaf, its longest line first
    d = fenced(d, "each", F.sort_array(F.transform("plain", lambda s: F.struct(leaf_of(s).alias("leaf"), (-F.length(s)).alias("k"), s.alias("line"))))).select("doc", "each")
    tops = F.filter("each", lambda x, i: (i == 0) | (x["leaf"] != F.get("each", i - 1)["leaf"]))
    tops = F.slice(F.sort_array(F.transform(tops, lambda x: F.struct(x["k"], x["line"], x["leaf"]))), 1, MAIN_LINES + 1)
    d = fenced(d, "tops", F.transform(tops, lambda x: F.struct(x["leaf"].alias("leaf"), F.xxhash64(leading(x["line"])).alias("opening"))))
    rows = d.select("doc", "tops", F.explode("each").alias("x"))
    mains = F.slice(F.transform(F.filter("tops", lambda t: t["leaf"] != F.col("x.leaf")), lambda t: t["opening"]), 1, MAIN_LINES)
    return rows.select("doc", F.xxhash64("x.line").alias("key"), "x.leaf", "x.line", mains.alias("mains"))


def spread_of(seen: DataFrame, *by: str) -> DataFrame:
    """families and documents of each group; ``seen`` has a row or more per group, family and document."""
    per = seen.groupBy(*by, "family", "doc").agg(F.lit(1).alias("one"))
    per = per.groupBy(*by, "family").agg(F.count("*").alias("docs"))
    return per.groupBy(*by).agg(F.count("*").alias("families"), F.sum("docs").alias("docs"))


def recurs() -> Column:
    return (F.col("families") >= MIN_FAMILIES) & (2 * F.col("families") >= F.col("docs"))


def open_groups(spread: DataFrame) -> DataFrame:
    """Groups that the first rule leaves, with documents enough for the second."""
    return spread.where(~recurs() & (F.col("docs") >= MIN_FAMILIES))


def own_families(members: DataFrame, *by: str) -> DataFrame:
    """The groups that the second rule finds; ``members`` has a row or more per group and document, with its mains."""
    openings = members.select(*by, "doc", F.size("mains").alias("n"), F.explode_outer("mains").alias("opening")).distinct()
    shared = openings.groupBy(*by, "opening").agg(F.count("*").alias("docs"), F.min("doc").alias("doc"), F.min("n").alias("n"))
    alone = shared.where((F.col("docs") == 1) & (F.col("n") >= OWN_LINES)).groupBy(*by, "doc").agg(F.count("*").alias("alone"), F.min("n").alias("n"))
    alone = alone.where(F.col("alone") == F.col("n")).groupBy(*by).agg(F.count("*").alias("own"))
    enough = (F.col("own") >= MIN_FAMILIES) | (F.col("own") == MIN_FAMILIES - 1) & (F.col("docs") > F.col("own"))
    return alone.where(F.col("own") >= MIN_FAMILIES - 1).join(members.groupBy(*by).agg(F.count_distinct("doc").alias("docs")), [*by]).where(enough).select(*by)


def forms(lines: DataFrame, spread: DataFrame) -> DataFrame:
    """key, form, template of the lines whose form is a template; ``spread`` has the families of each line."""
    # leaves where no single line tells the whole story
    leaves = spread.groupBy("leaf").agg(F.count("*").alias("forms"), F.sum("families").alias("reach"))
    leaves = stored(leaves.where((F.col("forms") > 1) & (F.col("reach") >= MIN_FAMILIES)).select("leaf"), "templates-leaves")
    texts = lines.select("leaf", "key", "line").join(leaves, "leaf", "left_semi").groupBy("leaf", "key").agg(F.min("line").alias("line"))
    texts = texts.join(spread.select("leaf", "key", "families"), ["leaf", "key"])
    tokens = stored(texts.select("leaf", "key", "families", F.posexplode(F.split("line", " ")).alias("pos", "token")), "templates-tokens")
    constant = tokens.groupBy("leaf", "pos", "token").agg(F.sum("families").alias("w")).where((F.col("w") >= MIN_FAMILIES) & (F.col("token") != FIELD)).select("leaf", "pos", "token", F.lit(True).alias("fixed"))
    parts = tokens.join(constant, ["leaf", "pos", "token"], "left")
    shape = parts.groupBy("leaf", "key").agg(F.count("fixed").alias("fixed"), F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("pos", F.when(F.col("fixed"), F.col("token")).otherwise(FIELD).alias("token")))).alias("parts"))
    shape = shape.where(F.col("fixed") >= CONSTANT * F.col("n")).select("leaf", "key", F.array_join("parts.token", " ").alias("template"))
    return shape.select("key", F.xxhash64("leaf", "template").alias("form"), "template")


def recurring_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, keys): all distinct lines by document, and the keys of those to drop with their template."""
    lines = stored(lines_of(docs), "templates-lines")
    family = F.coalesce(F.get("mains", F.lit(0)), F.lit(0)).alias("family")
    spread = stored(spread_of(lines.select("leaf", "key", family, "doc"), "leaf", "key"), "templates-spread")
    members = stored(forms(lines, spread), "templates-forms")
    of_form = lines.select("key", family, "doc", "mains").join(members.select("key", "form"), "key")
    of_form = stored(of_form.select("form", "family", "doc", "mains"), "templates-form-lines")
    form_spread = stored(spread_of(of_form, "form"), "templates-form-spread")
    # what the first rule leaves, by documents that share no main line
    by_line = lines.select("key", "doc", "mains").join(open_groups(spread).select("key"), "key", "left_semi")
    by_form = of_form.select("form", "doc", "mains").join(open_groups(form_spread).select("form"), "form", "left_semi")
    groups = by_line.select(F.lit(False).alias("whole"), F.col("key").alias("group"), "doc", "mains").unionByName(by_form.select(F.lit(True).alias("whole"), F.col("form").alias("group"), "doc", "mains"))
    found = stored(own_families(stored(groups, "templates-open"), "whole", "group"), "templates-found")
    good = form_spread.where(recurs()).select("form").unionByName(found.where("whole").select(F.col("group").alias("form")))
    by_template = members.join(good, "form", "left_semi").select("key", "template")
    lone = spread.where(recurs()).select("key").unionByName(found.where("not whole").select(F.col("group").alias("key")))
    every = by_template.unionByName(lone.select("key", F.lit(None).cast("string").alias("template")))
    return lines, stored(every.groupBy("key").agg(F.max("template").alias("template")), "templates-keys")


def without_templates(docs: DataFrame, counts: bool = False) -> DataFrame:
    """The documents with recurring template lines dropped; n_chars follows the text.

    With ``counts``, n_lines and n_dropped are added.
    """
    prepare(docs.sparkSession)
    seen, keys = recurring_lines(docs)
    per_doc = stored(seen.select("key", "doc").join(keys, "key", "left_semi").groupBy("doc").agg(F.collect_set("key").alias("__drop")).withColumnRenamed("doc", "__doc"), "templates-docs")
    # one plan at every size: both sides by hash of the text
    rows = docs.withColumn("__hash", F.xxhash64("text")).join(per_doc.hint("merge"), F.col("__hash") == F.col("__doc"), "left")
    lines = F.split("text", "\n")

    # blank lines have no key, so none is ever dropped; the generator keeps the work from being repeated per use
    kept = F.filter(lines, lambda line: ~F.array_contains("__drop", F.xxhash64(masked(line))))
    rows = rows.select("*", F.explode(F.array(F.when(F.col("__drop").isNull(), lines).otherwise(kept))).alias("__kept"))
    if counts:
        rows = rows.withColumn("n_lines", F.size(lines).cast("long")).withColumn("n_dropped", (F.size(lines) - F.size("__kept")).cast("long"))
    rows = rows.withColumn("text", F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join("__kept", "\n")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        rows = rows.withColumn("n_chars", F.when(F.col("__drop").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return rows.drop("__hash", "__doc", "__drop", "__kept")


def document_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines, n_dropped of every document; null texts have no lines."""
    rows = without_templates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), counts=True)
    zero = F.col("text").isNull()
    return rows.select("doc_id", "text", F.when(zero, 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"), F.when(zero, 0).otherwise(F.col("n_dropped")).cast("long").alias("n_dropped"))
