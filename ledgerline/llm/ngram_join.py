"""Jaccard self-join of the documents' shingle sets, and its connected components.

Method: token-combination prefixes.  A token is a shingle's hash, and a
document's tokens are ordered by hash.  Two sets of similarity 0.75 or more
share at least ``m`` tokens among each one's first ``n - ceil(0.75 n) + m``;
the prefixes are extended to ``m = EXTEND`` or a sixteenth of the set, whichever
is more (fewer in small sets).

* Rare tokens (at most ``RARE`` sets have them in their prefix) are indexed
  alone: their lists are short, and every pair in a list is a candidate unless
  sizes, or the count of shared tokens up to the last one, rule it out.
* Frequent tokens: a pair that shares no rare token shares ``m`` frequent ones,
  so only sets with that many frequent tokens are looked at.  Near copies of
  one text are the usual case: each set is first tied to the plainest set of
  its lists, then, by whole sets, to the most central one that is in another
  component.  For what is then not in one component, the sets' whole token
  lists are ordered by their frequency among these sets, rarest first, and the
  prefixes of that order are indexed: combinations of two tokens where a set
  has few tokens that others have too, single tokens where it has many.

Candidates are verified by exact intersection of the whole sets.  Documents
with equal sets are one node throughout (a 64-bit hash of the set), so copies
make no pairs; components come from ``common.components``.

Defined results: null or empty text, or no words: an empty set, linked with
nothing, its own component; fewer words than a shingle: the whole sequence is
the one shingle; null doc_id: kept, and ignored where a smallest id is taken
(null if a component has no other); repeated rows: linked, as equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import components, ready, stored
from ledgerline.llm.words import Roller, Texts, WordHasher, mixed, texts

SHINGLE = 5
#: Similarity as a fraction of whole numbers.
PART, WHOLE = 3, 4
#: Sets that may have a token in their prefix before it counts as frequent.
RARE = 16
#: Tokens that similar sets must share in their extended prefixes: EXTEND, or 1 / EXTEND_PART of a larger set.
EXTEND, EXTEND_PART = 16, 16
#: A set with so many tokens left to pair is indexed by single tokens.
FEW = 16
#: Rows of 16 bytes that are broadcast at most; beyond, the texts are shuffled.
BROADCAST_ROWS = 1 << 20

_hash, _roll = WordHasher(501), Roller(502)


def shingle_sets(t: Texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    prefix = _roll.prefix(_hash(t.data, t.starts, t.ends))
    every = mixed(_roll.windows(prefix, size))
    for a, b in zip(t.first[:-1].tolist(), t.first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        elif b > a:
            yield mixed(_roll.runs(prefix, np.array([a]), np.array([b])))
        else:
            yield every[:0]


def _node(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, node = [], []
        for t in texts(batch.column("text"), lower=True):
            for s in shingle_sets(t):
                n.append(len(s))
                node.append(_node(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "key", "row")), pa.array(n, pa.int64()), pa.array(node, pa.int64())],
            ["doc_id", "key", "row", "n", "node"],
        )


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, node, n, rank) of every set's extended prefix.

    A task sends a set it has seen only once, and spreads the rows of a token
    by a salt as soon as it has sent more than RARE of them itself.
    """
    nodes: set[int] = set()
    sent: dict[int, int] = {}
    for t in (t for batch in batches for t in texts(batch.column("text"), lower=True)):
        parts, sizes, ids, ns = [], [], [], []
        for s in shingle_sets(t):
            n = len(s)
            if not n:
                continue
            node = _node(s)
            if node in nodes:
                continue
            nodes.add(node)
            need = -(-PART * n // WHOLE)
            parts.append(s[: n - need + min(max(EXTEND, n // EXTEND_PART), need)] >> np.uint64(16))
            sizes.append(len(parts[-1]))
            ids.append(node)
            ns.append(n)
        if len(nodes) > 1 << 20:
            nodes.clear()
            sent.clear()
        if not parts:
            continue
        token = np.concatenate(parts).view(np.int64)
        size = np.array(sizes)
        node, n = np.repeat(np.array(ids, np.int64), size), np.repeat(np.array(ns, np.int32), size)
        rank = (np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
        salt = np.zeros(len(token), np.int32)
        order = np.argsort(token, kind="stable")
        starts = np.flatnonzero(np.append(True, token[order][1:] != token[order][:-1]))
        counts = np.diff(np.append(starts, len(token)))
        for at in np.flatnonzero(counts >= 4).tolist():
            own = order[starts[at] : starts[at] + counts[at]]
            before = sent.get(int(token[own[0]]), 0)
            sent[int(token[own[0]])] = before + len(own)
            rest = own[max(0, RARE + 1 - before) :]
            salt[rest] = 1 + (node[rest] & 0xFFF)
        if len(sent) > 1 << 18:
            sent = {k: v for k, v in sent.items() if v > RARE}
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (salt, n, node, rank, token)], ["salt", "n", "node", "rank", "token"]
        )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
        sides = ([], [])
        for name, out in zip(("text_a", "text_b"), sides, strict=True):
            for t in texts(batch.column(name), lower=True):
                out.extend(shingle_sets(t))
        same = []
        for x, y in zip(*sides, strict=True):
            both = len(np.intersect1d(x, y, assume_unique=True))
            same.append(WHOLE * both >= PART * (len(x) + len(y) - both))
        keep = pa.array(same, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])


def _similar_sizes(x: str, y: str) -> str:
    return f"{WHOLE} * least({x}, {y}) >= {PART} * greatest({x}, {y})"


def whole_texts(wanted: DataFrame, docs: DataFrame, signatures: DataFrame) -> DataFrame:
    """node and text (of one document) for the wanted nodes."""
    keys = stored(
        signatures.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key")), "join-wanted"
    )
    small = keys.count() <= BROADCAST_ROWS
    # Copies of a text combine before the shuffle.
    return (
        docs.select("text", F.xxhash64("text").alias("key"))
        .join(F.broadcast(keys) if small else keys, "key")
        .groupBy("node")
        .agg(F.first("text").alias("text"))
    )


def verify(edges: DataFrame, docs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The candidate ``edges`` (a, b: nodes) whose whole sets reach the similarity."""
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    whole = whole_texts(ends, docs, signatures)
    pairs = edges.join(whole.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        whole.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long")


def _rare_pairs(lists: DataFrame, frequent: DataFrame) -> DataFrame:
    """Candidate pairs by single rare tokens, after the size and position filters."""
    x = lists.select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("rank").alias("ra"))
    y = lists.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("rank").alias("rb"))
    many = frequent.groupBy("node").agg(F.count(F.lit(1)).alias("f"))
    return (
        x.join(y, "token")
        .where(f"a < b and {_similar_sizes('na', 'nb')}")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("c"), F.max("ra").alias("ra"), F.max("rb").alias("rb"), F.min("na").alias("na"), F.min("nb").alias("nb"))
        .join(many.select(F.col("node").alias("a"), F.col("f").alias("fa")), "a", "left")
        .join(many.select(F.col("node").alias("b"), F.col("f").alias("fb")), "b", "left")
        # Shared tokens: those counted, frequent ones of the prefixes, and what follows the last one counted.
        .where(
            f"{PART + WHOLE} * (c + least(coalesce(fa, 0), coalesce(fb, 0)) + least(na - ra - 1, nb - rb - 1))"
            f" >= {PART} * (na + nb)"
        )
        .select("a", "b", "c")
    )


#: Frequent tokens that similar sets share at least when they share no rare one; least is the smallest partner's size.
_LEAST = f"ceil({PART} * n / {WHOLE})"
_NEED = f"least(greatest({EXTEND}, {_LEAST} div {EXTEND_PART}), ceil({PART} * {_LEAST} / {WHOLE}))"


def _enough(rows: DataFrame) -> DataFrame:
    """Rows (token, node, n, ...) of the sets that have as many frequent tokens as they would need."""
    return (
        rows.withColumn("f", F.count(F.lit(1)).over(Window.partitionBy("node")))
        .withColumn("need", F.expr(_NEED))
        .where("f >= need")
    )


def _class(n: str = "n") -> Column:
    """Sets of one class have sizes that may be similar."""
    return F.floor(F.log(n) / F.log(F.lit(WHOLE / PART)))


def _stars(rows: DataFrame) -> DataFrame:
    """For every set of the ``rows`` (token, node, n, central), the most central set of most of its lists."""
    rows = rows.withColumn("class", _class())
    hubs = rows.groupBy("token", "class").agg(F.max_by("node", F.struct("central", "node")).alias("hub"))
    near = (
        rows.join(hubs, ["token", "class"])
        .where("node <> hub")
        .groupBy("node", "hub")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("node")
        .agg(F.max_by("hub", F.struct("c", "hub")).alias("other"))
    )
    return near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _whole_stars(tokens: DataFrame) -> DataFrame:
    """Stars by the whole sets: the most central set shares the largest part of its tokens with the others, on average."""
    tokens = tokens.select("node", "n", "token")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    share = F.sum("sets").over(Window.partitionBy("node")) / F.col("n")
    return _stars(tokens.join(often, "token").select("token", "node", "n", share.alias("central")))


def _closest(pairs: DataFrame) -> DataFrame:
    """For every set of the candidate pairs, the partner it shares most tokens with."""
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), "c").union(pairs.select("b", "a", "c"))
    best = both.groupBy("node").agg(F.max_by("other", F.struct("c", "other")).alias("other"))
    return best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _sketch(s: np.ndarray) -> np.ndarray:
    """A bitmap of four to eight bits per token, as 64-bit words; a bit is set if any token falls on it."""
    size = max(256, 1 << (4 * len(s) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(s & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All tokens of every set; the row of its first token has the set's sketch."""
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        for t in texts(batch.column("text"), lower=True):
            sets = list(shingle_sets(t))
            n = np.array([len(s) for s in sets], np.int32)
            sketches = [_sketch(s) for s in sets]
            first = np.cumsum(n) - n
            sizes = np.zeros(int(n.sum()), np.int32)
            sizes[first] = [len(x) for x in sketches]
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            sketch = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sketches)), mask=pa.array(sizes == 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(nodes[t.rows], n)), pa.array(np.repeat(n, n)), pa.array(np.concatenate(sets).view(np.int64)), sketch],
                ["node", "n", "token", "sketch"],
            )


def _combinations(tokens: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of sets in different components, given all tokens of the sets (node, n, token).

    Tokens are ordered by how many of these sets have them, rarest first.  The
    first two tokens that sets of overlap t share are at places up to n - t and
    n - t + 1 of either; t is 3/7 of both sizes, 3/4 of one's own at least.
    Bits of one set's sketch that the other's lacks are as many tokens that it
    lacks, or more; n - t of them are the most that similar sets allow.
    """
    sketches = tokens.where("sketch is not null").select("node", "sketch")
    tokens = tokens.drop("sketch")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    order = Window.partitionBy("node").orderBy("sets", "token")
    shared = tokens.join(often, "token").withColumn("own", F.count(F.lit(1)).over(Window.partitionBy("node")))
    first = _rooted(
        # Tokens that no other set has come first; they are counted, not listed.
        shared.withColumn("place", F.row_number().over(order) - 1 + F.col("n") - F.col("own")).where(
            f"place <= n - ceil({PART} * n / {WHOLE}) + 1"
        ),
        roots, "node", "root",
    ).join(sketches, "node").withColumn("few", F.count(F.lit(1)).over(Window.partitionBy("node")) <= FEW)

    lists = first.where("few").groupBy("node", "n", "root").agg(
        F.sort_array(F.collect_list(F.struct("place", "token"))).alias("l"), F.first("sketch").alias("sketch")
    )
    two = lists.select(
        "node", "n", "root", "sketch",
        F.explode(
            F.expr(
                "flatten(transform(l, (x, i) -> transform(slice(l, i + 2, size(l)),"
                " y -> struct(x.token as t1, y.token as t2, x.place as p1, y.place as p2))))"
            )
        ).alias("t"),
    ).select("node", "n", "root", "sketch", "t.*")
    one = first.select("node", "n", "root", "few", "sketch", F.col("token").alias("t1"), F.col("place").alias("p1"))

    def sides(x: DataFrame, y: DataFrame, *keys: str) -> DataFrame:
        """x joined with y on the keys."""
        for name in ("a", "b"):
            z = x if name == "a" else y
            z = z.select(*keys, *(F.col(c).alias(c + name) for c in ("node", "n", "root", "sketch", "p1", *(["p2"] if "t2" in keys else []))))
            x, y = (z, y) if name == "a" else (x, z)
        return x.join(y, list(keys)).withColumn("least", F.expr(f"cast(ceil({PART} * (na + nb) / {PART + WHOLE}) as int)"))

    apart = f"roota <> rootb and {_similar_sizes('na', 'nb')} and p1a <= na - least and p1b <= nb - least"
    lacks = "aggregate(zip_with(sketch{}, sketch{}, (p, q) -> bit_count(p & ~q)), 0, (s, v) -> s + v)"
    alike = (
        f"(size(sketcha) <> size(sketchb) or ({lacks.format('a', 'b')} <= na - least and {lacks.format('b', 'a')} <= nb - least))"
    )
    by_two = sides(two, two, "t1", "t2").where(f"nodea < nodeb and {apart} and p2a <= na - least + 1 and p2b <= nb - least + 1 and {alike}")
    by_one = sides(one.where("not few"), one, "t1").where(f"{apart} and {alike}")
    return (
        by_two.select("nodea", "nodeb").union(by_one.select("nodea", "nodeb"))
        .select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b"))
        .distinct()
    )


def _rooted(rows: DataFrame, roots: DataFrame, node: str, out: str) -> DataFrame:
    found = roots.select(F.col("node").alias(node), F.col("root").alias(out))
    return rows.join(found, node, "left").withColumn(out, F.coalesce(out, node))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets in different components."""
    return _rooted(_rooted(pairs, roots, "a", "ra"), roots, "b", "rb").where("ra <> rb").select("a", "b")


def _merged(roots: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """The components with more links between them."""
    if not links.limit(1).count():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links), label)


def join_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), root (equal within a component,
    null for an empty set) and row, a 64-bit hash of the document's id and text."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signatures = stored(
        docs.withColumn("key", F.xxhash64("text"))
        .withColumn("row", F.xxhash64("doc_id", "text"))
        .mapInArrow(_signatures, "doc_id long, key long, row long, n long, node long"),
        "join-signatures",
    )
    of_token = Window.partitionBy("token", "salt")
    postings = (
        docs.select("text")
        .mapInArrow(_postings, "salt int, n int, node long, rank int, token long")
        .repartition("token", "salt")
        .withColumn("sets", F.count(F.lit(1)).over(of_token))
        .where("sets > 1 or salt > 0")
        .dropDuplicates(["token", "salt", "node"])
        .withColumn("sets", F.count(F.lit(1)).over(of_token))
        .where("sets > 1 or salt > 0")
    )
    lists = stored(postings.select("token", "node", "n", "rank", F.expr(f"salt > 0 or sets > {RARE}").alias("often")), "join-lists")
    rare = lists.where("not often")
    often = lists.where("often").select("token", "node", "n").distinct()
    close = stored(_rare_pairs(rare, often), "join-candidates")
    often = stored(_enough(often), "join-frequent")

    first = stored(_closest(close).union(_stars(often.withColumn("central", F.expr("f / n")))).distinct(), "join-first")
    links = stored(verify(first, docs, signatures), "join-links")
    roots = components(links, "join-components")

    still = _rooted(often.select("token", "node", "n"), roots, "node", "root")
    mixed_lists = still.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
    still = _enough(still.join(mixed_lists.select("token"), "token", "left_semi")).select("node").distinct()
    tokens = stored(
        whole_texts(still, docs, signatures).mapInArrow(_whole_sets, "node long, n int, token long, sketch array<long>"), "join-tokens"
    )
    second = stored(_apart(_whole_stars(tokens), roots).join(first, ["a", "b"], "left_anti"), "join-second")
    roots = _merged(roots, stored(verify(second, docs, signatures), "join-second-links"), "join-again")

    tried = first.union(second)
    rest = _apart(close, roots).union(_combinations(tokens, roots)).distinct().join(tried, ["a", "b"], "left_anti")
    roots = _merged(roots, stored(verify(stored(rest, "join-rest"), docs, signatures), "join-more"), "join-final")

    rooted = _rooted(signatures.select("doc_id", "n", "node", "row"), roots, "node", "root")
    smallest = rooted.where("node is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    return rooted.join(smallest, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"),
        "root",
        "row",
    )
