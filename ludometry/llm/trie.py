"""The prefix trie of conversations by vertical bitmaps.

Conversations stand in order of their id and are cut into shards of bounded size.
In a shard every (position, turn) is indexed to a bitset of its conversations, and
every length to the bitset of those that end there. Depth first, the bitset of a
node is intersected with the postings of the turns at the next position: what is
left are its children; popcounts count members, and bits at the end their list.

A node that several shards know is told by a 128-bit hash of its path. Counts of
members add up over shards. What must count a node once (children, leaves and
words below a node) is summed in the shard that owns the node, the first one that
knows it, and then added up: no step goes level by level, so the depth of a
conversation costs no rounds, and no task meets more than one row of a node and
shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludometry.llm.base import written

# A shard is closed at so many conversations or turns; a longer conversation is one alone.
CONVERSATIONS, TURNS = 2_048, 65_536
WORDS = r"[^\x20\x09-\x0D]+"
ROOT = bytes(16)
LOCAL = (
    "shard long, place int, parent int, depth int, node binary, words long, "
    "members long, member_words long, least long, childless boolean, ends binary"
)
_LOCAL = pa.schema(
    [("shard", pa.int64()), ("place", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("node", pa.binary())]
    + [(name, pa.int64()) for name in ("words", "members", "member_words", "least")]
    + [("childless", pa.bool_()), ("ends", pa.binary())]
)
_EMPTY = hashlib.sha256().hexdigest()


def turns_of(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """(conv_id, place, turn, words): the turns of every conversation, without their texts.

    Turns stand by number, null first; those of one number by role and by a digest
    of the text. ``place`` counts from 0, ``turn`` is a 128-bit digest of role and
    text, null being empty. Rows without a conv_id belong to no conversation;
    repeated rows are turns of their own; other columns are ignored.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The length of the role keeps (ab, c) and (a, bc) apart.
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = rows.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("number"),
        role.alias("role"),
        F.unhex(F.md5(whole.cast("binary"))).alias("turn"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("number").asc_nulls_first(), "role", "turn")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "turn", "words")


def with_heads(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Conversations (conv_id, place, turn, words) whose first turns are those of another.

    The first ``heads`` turns, ``most`` at the utmost, are taken from conversation
    ``base`` (columns of conv_id): all if it has fewer, none if it is absent. The
    own turns from that place on follow. A conversation that is left without a
    turn is one row with nulls.
    """
    known = written(turns.select("conv_id", "place", "turn", "words"), "turns")
    each = known.filter("place = 0").select("conv_id", base.alias("base"), heads.alias("heads"))
    first = known.filter(F.col("place") < most).select(
        F.col("conv_id").alias("base"), "place", "turn", "words"
    )
    taken = each.join(first, "base").filter("place < heads").select("conv_id", "place", "turn", "words")
    own = known.filter(F.col("place") >= heads)
    made = taken.unionByName(own)
    # A row for the conversation itself, which sorts before its turns.
    alone = each.select("conv_id", F.lit(-1).alias("place"), F.lit(None).cast("binary").alias("turn"), F.lit(None).cast("long").alias("words"))
    return made.unionByName(alone)


def _conversations(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[bytes, int]]]]:
    """(conv_id, its turns and their words), from rows sorted by conv_id and place."""

    def rows():
        for batch in stream:
            yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "words")), strict=True)

    for key, own in groupby(rows(), key=lambda row: row[0]):
        yield key, [(turn, words) for _, turn, words in own if turn is not None]


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def shard_nodes(shard: list[tuple[int, list[tuple[bytes, int]]]]) -> Iterator[tuple]:
    """Rows of LOCAL of the trie of some conversations in order of their ids, parents first."""
    ids = [key for key, _ in shard]
    postings: dict[tuple[int, bytes], int] = {}
    ending: dict[int, int] = {}
    # Words of a conversation from a position on.
    rest: list[list[int]] = []
    for number, (_, turns) in enumerate(shard):
        bit = 1 << number
        for position, (turn, _) in enumerate(turns):
            postings[position, turn] = postings.get((position, turn), 0) | bit
        ending[len(turns)] = ending.get(len(turns), 0) | bit
        sums = [0]
        for _, words in reversed(turns):
            sums.append(sums[-1] + words)
        rest.append(sums[::-1])
    place = 0
    # (bitset, depth, hash of the path, words of the last turn, place of the parent)
    stack = [((1 << len(ids)) - 1, 0, ROOT, 0, -1)]
    while stack:
        members, depth, node, words, parent = stack.pop()
        ends = members & ending.get(depth, 0)
        left, children = members & ~ends, []
        while left:
            first = (left & -left).bit_length() - 1
            turn, own = shard[first][1][depth]
            child = members & postings[depth, turn]
            children.append((child, depth + 1, xxhash.xxh3_128_digest(node + turn), own, place))
            left &= ~child
        below = sum(rest[m][max(depth - 1, 0)] for m in _bits(members))
        least = ids[(members & -members).bit_length() - 1]
        listed = ",".join(str(ids[m]) for m in _bits(ends)).encode() if ends else None
        yield ids[0], place, parent, depth, node, words, members.bit_count(), below, least, not children, listed
        place += 1
        stack.extend(reversed(children))


def _local(conversations: int, turns: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(shard: list) -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            for row in shard_nodes(shard):
                rows.append(row)
                if len(rows) >= 10_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

        shard, held = [], 0
        for key, own in _conversations(stream):
            if shard and (len(shard) >= conversations or held + len(own) > turns):
                yield from made(shard)
                shard, held = [], 0
            shard.append((key, own))
            held += len(own)
        if shard:
            yield from made(shard)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _LOCAL, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_LOCAL)


def local_nodes(conversations: DataFrame, most: int = CONVERSATIONS, turns: int = TURNS) -> DataFrame:
    """LOCAL: the tries of all shards, written.

    ``conversations`` has conv_id, place, turn, words, see ``turns_of``. Shards are
    runs of the order of ids, so end lists of later shards follow earlier ones.
    """
    rows = conversations.select("conv_id", "place", "turn", "words")
    dealt = rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "place")
    return written(dealt.mapInArrow(_local(most, turns), LOCAL), "local")


def _owned(shard: pd.DataFrame) -> pd.DataFrame:
    """Of a shard's nodes, the sums over what the shard owns of the subtrees; children after parents."""
    shard = shard.sort_values("place")
    parent = shard["parent"].tolist()
    words = (shard["words"] * shard["owned"]).tolist()
    leaves = (shard["owned"] & shard["leaf"]).astype(int).tolist()
    children = [0] * len(shard)
    owned = shard["owned"].astype(int).tolist()
    for k in range(len(parent) - 1, 0, -1):
        words[parent[k]] += words[k]
        leaves[parent[k]] += leaves[k]
        children[parent[k]] += owned[k]
    ids = shard["conv_id"].tolist()
    above = [None if p < 0 else ids[p] for p in parent]
    out = shard[["node", "depth", "conv_id", "n_convs", "member_words"]].copy()
    out["parent_conv_id"] = pd.array(above, dtype="Int64")
    out["n_children"], out["n_leaves"], out["own_words"] = children, leaves, words
    return out


_OWNED = (
    "node binary, depth int, conv_id long, n_convs long, member_words long, "
    "parent_conv_id long, n_children long, n_leaves long, own_words long"
)


def nodes(local: DataFrame) -> DataFrame:
    """One row per node: node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.

    ``node`` is the hash of the path, conv_id the smallest member, n_leaves the
    childless nodes of the subtree, itself included, and saved_tokens the words
    that its members need not compute again: of every node of the subtree, the
    words of its last turn times the members after the first. No conversation, no node.
    """
    known = local.groupBy("node").agg(
        F.sum("members").alias("n_convs"),
        F.min("least").alias("conv_id"),
        F.min("shard").alias("owner"),
        F.min("childless").alias("leaf"),
    )
    own = local.drop("ends", "members", "least", "childless").join(known, "node")
    shards = own.withColumn("owned", F.col("shard") == F.col("owner")).drop("owner").groupBy("shard")
    parts = shards.applyInPandas(_owned, _OWNED)
    return parts.groupBy("node").agg(
        F.max("conv_id").alias("conv_id"),
        F.max("depth").cast("long").alias("depth"),
        F.max("parent_conv_id").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        (F.sum("member_words") - F.sum("own_words")).alias("saved_tokens"),
    )


def end_lists(local: DataFrame) -> DataFrame:
    """(node, shard, ends): the ids of the conversations that end at a node, a list for each shard."""
    ids = F.transform(F.split(F.col("ends").cast("string"), ","), lambda x: x.cast("long"))
    return local.filter("ends IS NOT NULL").select("node", "shard", ids.alias("ends"))


def _digested(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, ends) sorted by node and shard to the digest of the joined lists."""

    def rows():
        for batch in stream:
            yield from zip(batch["node"].to_pylist(), batch["ends"].to_pylist(), strict=True)

    made: list[tuple[bytes, str]] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.string())], ["node", "ends_sha256"])

    for node, own in groupby(rows(), key=lambda row: row[0]):
        digest = hashlib.sha256(next(own)[1])
        for _, ends in own:
            digest.update(b"," + ends)
        made.append((node, digest.hexdigest()))
        if len(made) >= 10_000:
            yield batch()
            made = []
    if made:
        yield batch()


def end_digests(local: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the comma-joined ids that end at a node, in order.

    One digest takes one task, through which the lists of a node stream.
    """
    rows = local.filter("ends IS NOT NULL").select("node", "shard", "ends")
    dealt = rows.repartition("node").sortWithinPartitions("node", "shard").select("node", "ends")
    return dealt.mapInArrow(_digested, "node binary, ends_sha256 string")


def trie(conversations: DataFrame, most: int = CONVERSATIONS, turns: int = TURNS) -> DataFrame:
    """``nodes`` of conversations (conv_id, place, turn, words), with the digests of their end lists."""
    local = local_nodes(conversations, most, turns)
    digests = end_digests(local)
    return nodes(local).join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
