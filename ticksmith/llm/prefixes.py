"""The prefix trie of rebuilt conversations, by whole-sequence collapse.

Conversations are rebuilt by the rule of ``rebuilt_turns``; a node of the trie
is a distinct sequence of first turns.  No trie is walked: each conversation is
a sequence, each prefix has a key (its depth and the sums of 128 bits of
position-dependent turn digests), and everything a node needs is a sum or a
minimum over the sequences that run through it.

1. Conversations with equal whole sequences collapse into one weighted
   sequence with its list of ends, carried on by its smallest conv_id.
2. Only these make prefix rows, with the running bytes of their texts.
3. Sequences that are no proper prefix of another are found by an anti-join;
   they are the leaves.
4. The nodes a sequence owns (those whose smallest member it is) are a suffix
   of it, from its depth ``first`` on; so children, and bytes of distinct nodes
   below any node, are sums over sequences as well.

A conversation may hold any share of all turns: turns are numbered, and sums
run, inside of blocks of bounded size, to which the totals of the blocks before
are added.  A node may have any share of all members or children: members are
pre-aggregated, ids of ends are packed in bounded texts before they meet, and a
parent's id reaches its many children by a broadcast of the at most
``HOT_PARENTS`` parents with more than that part of all nodes.

Rows without a conv_id take no part.  A null role or text counts as empty; null
turns come first and equal turns are ordered by a digest of role and text, so
repeated rows are turns of their own.  A conversation whose rebuilt sequence is
empty is a member of the root alone.  Without conversations there is no root
and no row.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticksmith.llm.common import arrow_schema, prepare, record_batch, stored

#: conversations that share the beginning of the one whose id divides by this
FAMILY = 5
#: shared turns are a remainder by this
SHARED_TURNS = 9
#: turns of a conversation that are summed in one group
BLOCK_TURNS = 4096
#: ids of ends in one packed text
PACKED_IDS = 4096
#: parents whose ids are broadcast, at most
HOT_PARENTS = 1000

KEY = ["d", "k0", "k1"]
PARTS = ["p0", "p1", "p2", "p3"]


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % SHARED_TURNS


def turn_digest() -> Column:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def running(*keys: str, order: str, until: int = 0):
    return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, until)


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c, d, digest, bytes) of rebuilt conversations, and (c, len) of all of them, the empty ones included.

    Conversation c has the first h turns of conversation c - c % 5, then its
    own after its first h, where h = crc32 of the decimal c, modulo 9.
    """
    order = ["conv_id", "turn", "digest"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest().alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    # sorted ranges: a conversation with many turns lies in several blocks, each of a task's size
    turns = stored(turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("block", F.spark_partition_id()), "trie-turns")
    blocks = turns.groupBy("block", "conv_id").agg(F.count("*").alias("n"))
    convs = blocks.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("donor", F.expr(f"conv_id - conv_id % {FAMILY}")).withColumn("h", shared_turns(F.col("conv_id")))
    donors = convs.select(F.col("conv_id").alias("donor"), F.col("n").alias("n_donor"))
    convs = convs.join(donors, "donor", "left").withColumn("taken", F.least("h", F.coalesce("n_donor", F.lit(0))))
    convs = stored(convs.select("conv_id", "donor", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "trie-conversations")

    before = F.coalesce(F.sum("n").over(running("conv_id", order="block", until=-1)), F.lit(0))
    places = blocks.select("block", "conv_id", before.alias("before")).join(convs.select("conv_id", "h", "taken"), "conv_id")
    within = F.row_number().over(W.partitionBy("block", "conv_id").orderBy("turn", "digest"))
    numbered = turns.withColumn("within", within).join(places, ["block", "conv_id"]).withColumn("pos", F.col("before") + F.col("within"))
    own = numbered.where("pos > h").select(F.col("conv_id").alias("c"), (F.col("taken") + F.col("pos") - F.col("h")).alias("d"), "digest", "bytes")
    heads = numbered.where(f"conv_id % {FAMILY} = 0 and pos < {SHARED_TURNS}").select(F.col("conv_id").alias("donor"), "pos", "digest", "bytes")
    shared = heads.join(convs.select(F.col("conv_id").alias("c"), "donor", "h"), "donor").where("pos <= h").select("c", F.col("pos").alias("d"), "digest", "bytes")
    return own.unionByName(shared), convs.select(F.col("conv_id").alias("c"), "len")


def key_columns(p: list[Column]) -> list[Column]:
    """Two longs from four sums of 32-bit parts, each modulo 2^32."""
    low = F.lit(0xFFFFFFFF)
    return [F.shiftleft(p[0], 32).bitwiseOR(p[1].bitwiseAND(low)).alias("k0"), F.shiftleft(p[2], 32).bitwiseOR(p[3].bitwiseAND(low)).alias("k1")]


def ends_digests(members: DataFrame) -> DataFrame:
    """(d, k0, k1, ends_sha256): SHA-256 of the comma-joined ascending ids of each whole sequence.

    Ids are sorted in ranges and packed ``PACKED_IDS`` at a time before one
    task per sequence feeds the packed texts, in order, to the digest; it holds
    one of them at a time.
    """
    spark = members.sparkSession
    packed_schema, schema = "d long, k0 long, k1 long, c long, ids string", "d long, k0 long, k1 long, ends_sha256 string"
    packed_target, target = arrow_schema(spark, packed_schema), arrow_schema(spark, schema)

    def pack(batches):
        key, ids = None, []

        def text():
            return record_batch({"d": [key[0]], "k0": [key[1]], "k1": [key[2]], "c": [ids[0]], "ids": [",".join(map(str, ids))]}, packed_target)

        for batch in batches:
            for *at, c in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if at != key or len(ids) == PACKED_IDS:
                    if ids:
                        yield text()
                    key, ids = at, []
                ids.append(c)
        if ids:
            yield text()

    def digest(batches):
        key, sha = None, None

        def row():
            return record_batch({"d": [key[0]], "k0": [key[1]], "k1": [key[2]], "ends_sha256": [sha.hexdigest()]}, target)

        for batch in batches:
            for *at, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if at == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        yield row()
                    key, sha = at, hashlib.sha256()
                sha.update(ids.encode())
        if key is not None:
            yield row()

    order = [*KEY, "c"]
    packed = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined(pack, packed_target), packed_schema)
    return packed.repartition(*KEY).sortWithinPartitions(*order).mapInArrow(joined(digest, target), schema)


def joined(rows, target: pa.Schema, size: int = 2_000):
    """``rows`` with its one-row batches put together."""

    def run(batches):
        held = []
        for b in rows(batches):
            held.append(b)
            if len(held) == size:
                yield pa.Table.from_batches(held, target).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held, target).combine_chunks().to_batches()[0]

    return run


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prepare(conversations.sparkSession)
    turns, convs = rebuilt_turns(conversations)
    low = F.lit(0xFFFFFFFF)
    x, y = F.xxhash64("d", "digest"), F.xxhash64("digest", "d")
    block = F.floor((F.col("d") - 1) / BLOCK_TURNS).alias("block")
    parts = [x.bitwiseAND(low), F.shiftrightunsigned(x, 32), y.bitwiseAND(low), F.shiftrightunsigned(y, 32)]
    turns = stored(turns.select("c", "d", block, "bytes", *(p.alias(n) for p, n in zip(parts, PARTS))), "trie-rebuilt")
    sums = [*PARTS, "bytes"]

    # 1. whole sequences
    blocks = turns.groupBy("c", "block").agg(*(F.sum(s).alias(s) for s in sums))
    whole = blocks.groupBy("c").agg(*(F.sum(s).alias(s) for s in sums))
    whole = convs.join(whole, "c", "left").na.fill(0, sums)
    members = stored(whole.select("c", F.col("len").alias("d"), *key_columns([F.col(p) for p in PARTS]), F.col("bytes").alias("total")), "trie-members")
    sequences = stored(members.groupBy(*KEY).agg(F.min("c").alias("c"), F.count("*").alias("weight"), F.first("total").alias("total")), "trie-sequences")

    # 2. prefixes of one conversation per sequence
    ahead = [F.coalesce(F.sum(s).over(running("c", order="block", until=-1)), F.lit(0)).alias(f"ahead_{s}") for s in sums]
    carriers = blocks.join(sequences.select("c", "weight", "total", F.col("d").alias("len")), "c").select("c", "block", "weight", "total", "len", *ahead)
    upto = running("c", "block", order="d")
    rows = turns.join(carriers, ["c", "block"])
    rows = rows.select("*", *((F.col(f"ahead_{s}") + F.sum(s).over(upto)).alias(f"upto_{s}") for s in sums))
    above = [k.alias(f"parent_{n}") for k, n in zip(key_columns([F.col(f"upto_{p}") - F.col(p) for p in PARTS]), ("k0", "k1"))]
    rows = rows.select("c", "block", "d", *key_columns([F.col(f"upto_{p}") for p in PARTS]), *above, "weight", "total", "len", (F.col("upto_bytes") - F.col("bytes")).alias("before"))
    zero = F.lit(0).cast("long")
    roots = sequences.select("c", zero.alias("block"), zero.alias("d"), *(zero.alias(k) for k in ("k0", "k1", "parent_k0", "parent_k1")), "weight", "total", F.col("d").alias("len"), zero.alias("before"))
    prefixes = stored(rows.unionByName(roots), "trie-prefixes")

    # 3. leaves: no proper prefix of another sequence
    leaves = sequences.join(prefixes.where("d < len").select(*KEY).distinct(), KEY, "left_anti").select("c", F.lit(1).alias("leaf"))

    # 4. from which depth on a sequence owns its nodes, and the bytes before it
    owners = prefixes.groupBy(*KEY).agg(F.min(F.struct("c", "before")).alias("own"))
    owned = owners.groupBy("own.c").agg(F.min(F.struct("d", "own.before")).alias("first"))
    facts = sequences.select("c", "d", "total").join(owned, "c", "left").join(leaves, "c", "left")
    facts = facts.select(
        "c", F.explode(F.expr(f"sequence(0L, (greatest(d, 1L) - 1) div {BLOCK_TURNS})")).alias("block"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
        F.coalesce("first.d", F.col("d") + 1).alias("first"), F.coalesce("first.before", "total").alias("first_before"),
    )
    below = F.sum(F.col("weight") * (F.col("total") - F.col("before"))) - F.sum(F.col("total") - F.greatest("before", "first_before"))
    nodes = prefixes.join(facts, ["c", "block"]).groupBy(*KEY).agg(
        F.min(F.struct("c", "first")).alias("own"), F.sum("weight").alias("n_convs"),
        F.sum(F.when((F.col("d") < F.col("len")) & (F.col("d") + 1 >= F.col("first")), 1).otherwise(0)).cast("long").alias("n_children"),
        F.sum("leaf").cast("long").alias("n_leaves"), below.alias("saved_tokens"), F.first("parent_k0").alias("parent_k0"), F.first("parent_k1").alias("parent_k1"),
    )
    nodes = nodes.select(*KEY, F.col("own.c").alias("conv_id"), F.col("own.first").alias("first"), "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_k0", "parent_k1")
    nodes = with_parents(stored(nodes, "trie-nodes"))

    nodes = nodes.join(ends_digests(members), KEY, "left")
    return nodes.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id: below its first node, a sequence's nodes have the parent before them; the first looks it up."""
    own = F.when(F.col("d") > F.col("first"), F.col("conv_id")).alias("parent_conv_id")
    inner = nodes.where("d = 0 or d > first").select("*", own)
    firsts = nodes.where("d > 0 and d = first")
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("k0").alias("parent_k0"), F.col("k1").alias("parent_k1"), F.col("conv_id").alias("parent_conv_id"), "n_children").where("n_children > 0")
    many, on = nodes.count() // HOT_PARENTS, ["d", "parent_k0", "parent_k1"]
    # children add up to the nodes, so at most HOT_PARENTS parents have more than that part of them
    hot = parents.where(F.col("n_children") > many).drop("n_children")
    known = firsts.join(F.broadcast(hot), on, "left")
    rest = known.where("parent_conv_id is null").drop("parent_conv_id").join(parents.where(F.col("n_children") <= many).drop("n_children"), on)
    return inner.unionByName(known.where("parent_conv_id is not null")).unionByName(rest)
