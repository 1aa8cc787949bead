"""Near-duplicate documents by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .joins import spread_join
from .shared import Scratch
from .shingles import FastSketch, band_hashes, shingle_rows

_SIGNED = "doc_id long, n_shingles long, print binary, bands array<long>"
#: Rows that are checked against one copy of a text, and the most copies: beyond them runs grow longer, as they stream.
_RUN, _COPIES = 64, 4096
#: Groups of at most so many members compare the members that their centre leaves open directly.
_SMALL = 16
#: Members nearest to a centre that the open members of a larger group meet as further centres, round by round.
_ROUNDS = ((0, 8), (8, 64))
#: Classes of a member's weight in a group, and the last of them.
_CLASSES, _LAST = 16, 127
_SEEN = [("a", pa.int64()), ("j", pa.int32()), ("b", pa.int64()), ("k", pa.int32()), ("r", pa.int64()), ("s", pa.int64()), ("size", pa.int64())]
_LINK = [("a", pa.int64()), ("b", pa.int64())]
_UNLIKE = [("a", pa.int64()), ("j", pa.int32()), ("b", pa.int64()), ("k", pa.int32()), ("es", pa.list_(pa.int64()))]


def sketch_documents(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, print (of the whole shingle set; null if empty) and band hashes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = FastSketch(bands * rows)
        for batch in batches:
            size, prints, keys = [], [], []
            for s in shingle_rows(batch.column(1), width):
                size.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                keys.append(band_hashes(sketch(s), bands).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "print", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, _SIGNED)


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate((x, y)))
    return int((both[1:] == both[:-1]).sum())


def _compare(hubs, a, j, s) -> Iterator[tuple]:
    """How far the set of member a is from each hub: shingles removed from the hub's and added to them."""
    for k, (b, h) in enumerate(hubs):
        both = _shared(s, h)
        yield a, j, b, k, len(h) - both, len(s) - both, len(h)


def _unlike(hubs, a, j, s) -> Iterator[tuple]:
    """The shingles that only one of member a and a hub has, the hub's first."""
    for k, (b, h) in enumerate(hubs):
        yield a, j, b, k, np.concatenate((np.setdiff1d(h, s, True), np.setdiff1d(s, h, True))).view(np.int64)


def _first_link(percent: int) -> Callable:
    def first(hubs, a, j, s) -> Iterator[tuple]:
        for b, h in hubs:
            if a != b and 100 * min(len(s), len(h)) >= percent * max(len(s), len(h)):
                both = _shared(s, h)
                if 100 * both >= percent * (len(s) + len(h) - both):
                    yield a, b
                    return

    return first


def meet(members: DataFrame, hubs: DataFrame, texts: DataFrame, width: int, emit: Callable, fields: list, work: Scratch, name: str) -> DataFrame:
    """Rows that emit(hubs, member, j, set) gives for every member (g, a) and the hubs (g, h) of its group g.

    texts: id and text.  A group's members meet its hubs' texts in runs of
    about _RUN rows; a group with more members has its hubs copied to several
    runs, so that no task gets a hot one whole.  A task holds the sets of one group's hubs and of
    one member at a time.  An id with several texts is met with each of them, as j-th of its id.
    """
    names, types = zip(*fields, strict=True)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, near, last = None, [], (None, None, -1)
        for batch in batches:
            out = []
            for g, part, a, h, s in zip(*(batch.column(k).to_pylist() for k in range(4)), shingle_rows(batch.column(4), width), strict=True):
                if (g, part) != key:
                    key, near, last = (g, part), [], (None, None, -1)
                if a is None:
                    if not (near and near[-1][0] == h and np.array_equal(near[-1][1], s)):
                        near.append((h, s))
                    continue
                if a == last[0] and np.array_equal(s, last[1]):
                    continue
                last = (a, s, last[2] + 1 if a == last[0] else 0)
                out += emit(near, a, last[2], s)
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], list(names))

    runs = F.least(F.ceil(F.col("n") / _RUN), F.lit(_COPIES)).cast("int").alias("runs")
    sized = work.keep(members.groupBy("g").agg(F.count(F.lit(1)).alias("n")).select("g", "n", runs), f"{name}-sizes")
    dealt = spread_join(members, sized, ["g"], ["a"]).select("g", F.pmod(F.xxhash64("a", F.lit(1)), "runs").cast("int").alias("part"), "a")
    # Sort-merge at every size, so that the plan is the same on small and large tables.
    left = dealt.join(texts.hint("merge"), F.col("a") == F.col("id")).select("g", "part", "a", F.lit(None).cast("long").alias("h"), "text")
    right = hubs.join(sized, "g").join(texts.hint("merge"), F.col("h") == F.col("id"))
    right = right.select("g", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("part"), F.lit(None).cast("long").alias("a"), "h", "text")
    met = left.unionByName(right).repartition("g", "part").sortWithinPartitions("g", "part", "a", "h", "text")
    kinds = {pa.int64(): "long", pa.int32(): "int"}
    return met.mapInArrow(task, ", ".join(f"{n} {kinds.get(t, 'array<long>')}" for n, t in fields))


class _Groups:
    """Links between members of one group that lie in different components so far.

    A group has a centre c and members x, each with the r shingles that it
    lacks of c's and the s that it has besides.  With
    W(x) = 100 r + p s, sets x and z are linked exactly if the number o of shingles
    that both of them lack, or both have besides, is such that
    (100 + p) o >= W(x) + W(z) - (100 - p) |c|.
    Members whose sum of weights is small enough need none, and are linked with c; a member that c leaves
    open needs more in common with z the farther z is from c.
    """

    def __init__(self, seen: DataFrame, texts: DataFrame, width: int, percent: int, work: Scratch):
        self.texts, self.width, self.percent, self.work = texts, width, percent, work
        self.slack = (100 - percent) * F.col("size")
        self.total = seen.count()
        self.seen = seen.withColumn("w", 100 * F.col("r") + percent * F.col("s"))

    def links(self) -> DataFrame:
        return self.seen.where(F.col("w") <= self.slack).select("a", "b")

    def place(self, component: DataFrame, name: str) -> DataFrame:
        """Members of the groups that span several components, with those components and the group's figures."""
        rows = self.seen.join(component.withColumnRenamed("node", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))
        rows = self.work.keep(rows, f"{name}-rows")
        groups = rows.groupBy("b", "k").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("w").alias("least"), F.count(F.lit(1)).alias("n"))
        centers = component.select(F.col("node").alias("b"), F.col("component").alias("own"))
        groups = groups.join(centers, "b", "left").withColumn("own", F.coalesce("own", "b"))
        groups = groups.where("low <> own or high <> own").select("b", "k", "least", "own", "n", F.col("n").alias("many"))
        groups = self.work.keep(groups, f"{name}-groups")
        return self.work.keep(spread_join(rows, groups, ["b", "k"], ["a"], self.total).withColumn("open", F.col("component") != F.col("own")), f"{name}-mixed")

    def merge(self, mixed: DataFrame, component: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """mixed after each component with new links has taken the name of one that it is linked to.

        Equal names still mean connected components; names that stay apart only cost comparisons that are
        not needed, since all links enter the components at the end.
        """
        of = {c: component.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}")) for c in "ab"}
        named = links.join(of["a"], "a", "left").join(of["b"], "b", "left").select(F.coalesce("c_a", "a").alias("component"), F.coalesce("c_b", "b").alias("to"))
        moved = named.where("component <> to").groupBy("component").agg(F.min("to").alias("to"))
        left = mixed.where("open").join(moved, "component", "left").withColumn("component", F.coalesce("to", "component")).drop("to")
        left = left.withColumn("open", F.col("component") != F.col("own"))
        return self.work.keep(left.unionByName(mixed.where("not open")), name)

    def needed(self, w: Column, other: Column) -> Column:
        return F.ceil((w + other - self.slack) / (100 + self.percent)).cast("long")

    def possible(self) -> Column:
        """Whether x_ and the other member may be linked, by their counts alone."""
        most = F.least("r", "x_r") + F.least("s", "x_s")
        return (F.col("component") != F.col("x_component")) & (most >= self.needed(F.col("w"), F.col("x_w")))

    def direct(self, mixed: DataFrame) -> DataFrame:
        """Pairs of small groups: each open member with at most _SMALL others."""
        few = mixed.where(F.col("many") <= _SMALL)
        x = few.where("open").select("b", "k", *(F.col(c).alias(f"x_{c}") for c in ("a", "r", "s", "w", "component")))
        return few.join(x, ["b", "k"]).where((~F.col("open") | (F.col("a") < F.col("x_a"))) & self.possible()).select("a", F.col("x_a").alias("b"))

    def nearest(self, big: DataFrame, first: int, last: int) -> DataFrame:
        """The first-th to last-th member of each group by weight, as hubs."""
        part = Window.partitionBy("b", "k", F.pmod(F.xxhash64("a"), F.lit(16))).orderBy("w", "a", "j")
        few = big.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= last)
        ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("b", "k").orderBy("w", "a", "j")))
        return ranked.where((F.col("rank") > first) & (F.col("rank") <= last)).select(F.col("b").alias("g"), F.col("a").alias("h")).distinct()

    def by_differences(self, mixed: DataFrame) -> DataFrame:
        """Pairs of large groups whose members share enough of their differences from the centre to be linked.

        Two members that must share o of d differences share one of the d - o + 1 rarest of each.
        Weights fall into classes, and a member enters for each class of open members with as many of its differences as
        that class demands: what only tells a member from the centre, as nearly all of its common ones do, meets nothing.
        """
        big = mixed.where(F.col("many") > _SMALL)
        waiting = self.work.keep(big.where("open").groupBy("b", "k").agg(F.max("many").alias("n"), F.min("w").alias("nearest")), "big-waiting")
        big = spread_join(big, waiting, ["b", "k"], ["a"], self.total)
        step = F.greatest(F.floor(self.slack / _CLASSES), F.lit(1)).cast("long")
        big = big.withColumn("step", step).withColumn("class", F.least(F.floor(F.col("w") / F.col("step")), F.lit(_LAST)).cast("int"))
        big = self.work.keep(big, "big")
        counts = big.agg(F.sum(F.col("r") + F.col("s"))).first()
        key = ["b", "k", "a", "j"]
        at = big.select(F.col("b").alias("g"), "a").distinct()
        es = self.work.keep(meet(self.work.keep(at, "big-at"), at.select("g", F.col("g").alias("h")).distinct(), self.texts, self.width, _unlike, _UNLIKE, self.work, "big-unlike"), "big-es")
        each = es.join(big, key).select(*big.columns, F.explode("es").alias("e"))
        # Only what an open member shares with one of another component can tell of a link that is still wanted.
        often = each.groupBy("b", "k", "e").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("any"), F.min("component").alias("low"), F.max("component").alias("high"))
        often = self.work.keep(often.where("any and low <> high").select("b", "k", "e", "n", F.col("n").alias("often")), "big-often")
        common = spread_join(each, often, ["b", "k", "e"], ["a"], counts[0])
        own = Window.partitionBy(*key)
        common = common.withColumn("spot", F.row_number().over(own.orderBy("often", "e"))).withColumn("shared", F.count(F.lit(1)).over(own))
        rows = common.withColumn("d", F.col("r") + F.col("s"))
        rows = rows.withColumn("spot", F.col("d") - F.col("shared") + F.col("spot"))
        first = F.col("spot") <= F.col("d") - self.needed(F.col("w"), F.col("nearest")) + 1  # else beyond the reach of every open member
        own_first = F.col("open") & (F.col("spot") <= F.col("d") - self.needed(F.col("w"), F.col("least")) + 1)
        rows = rows.where(first | own_first)
        rows = self.work.keep(rows.select("b", "k", "e", "often", "step", "class", "a", "r", "s", "w", "d", "spot", "size", "component", "open", "least"), "big-rows")
        x = rows.where(F.col("open") & (F.col("spot") <= F.col("d") - self.needed(F.col("w"), F.col("least")) + 1))
        at_e = x.groupBy("b", "k", "e").agg(F.collect_set("class").alias("classes"), F.min("component").alias("low"), F.max("component").alias("high"), F.max("often").alias("n"))

        def reaches(c: Column) -> Column:
            weight = F.greatest(c * F.col("step"), self.slack + 1)
            return F.col("spot") <= F.col("d") - self.needed(F.col("w"), weight) + 1

        # A class is at most _LAST, so a member enters a bounded number of times; where no open member of another component has its shingle, not at all.
        z = spread_join(rows, self.work.keep(at_e, "big-at-e"), ["b", "k", "e"], ["a"], counts[0]).where((F.col("low") != F.col("component")) | (F.col("high") != F.col("component")))
        z = z.drop("class").withColumn("class", F.explode(F.filter("classes", reaches)))
        key = ["b", "k", "e", "class"]
        x = x.select(*key, *(F.col(c).alias(f"x_{c}") for c in ("a", "r", "s", "w", "d", "spot", "component")))
        enough = self.needed(F.col("w"), F.col("x_w"))
        near = (F.col("spot") <= F.col("d") - enough + 1) & (F.col("x_spot") <= F.col("x_d") - enough + 1)
        met = z.join(x, key).where(near & self.possible())
        return met.select(F.least("a", "x_a").alias("a"), F.greatest("a", "x_a").alias("b")).distinct()


def by_center(members: DataFrame, work: Scratch) -> DataFrame:
    """Pairs (g, a): the central node of each key, whose keys are the most shared, with the others."""
    central = members.withColumn("pull", F.sum("many").over(Window.partitionBy("id")))
    centers = central.groupBy("key").agg(F.min_by("id", F.struct(-F.col("pull"), "id")).alias("center"), F.count(F.lit(1)).alias("n"))
    paired = spread_join(members, work.keep(centers, "centers"), ["key"], ["id"])
    return paired.where("id <> center").select(F.col("center").alias("g"), F.col("id").alias("a")).distinct()


def key_members(signed: DataFrame, own: str, work: Scratch, *more: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prints (doc_id, n_shingles, print), nodes (print, id, and the columns ``more``) and members (key, id, many) of keys that several nodes have.

    signed: doc_id, n_shingles, print and bands (keys of any number, equal for equal prints), read from the table of that
    name in work, which goes when it has been read.
    """
    some = signed.where("print is not null and doc_id is not null")
    nodes = work.keep(some.groupBy("print").agg(F.min("doc_id").alias("id"), *(F.min(c).alias(c) for c in ("bands", *more))), "keyed")
    signed = work.keep(signed.select("doc_id", "n_shingles", "print"), "prints")
    work.drop(own)
    work.release()
    keyed = nodes.select("id", F.explode("bands").alias("key"))
    shared = work.keep(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("many", F.col("n")), "shared")
    total = nodes.agg(F.sum(F.size("bands"))).first()[0] or 0
    work.release()
    members = work.keep(spread_join(keyed, shared, ["key"], ["id"], total), "members")
    nodes = work.keep(nodes.select("print", "id", *more), "nodes")
    for done in ("keyed", "shared"):
        work.drop(done)
    work.release()
    return signed, nodes, members


def texts_of(docs: DataFrame, pairs: DataFrame, work: Scratch) -> DataFrame:
    """id and text of the documents in pairs (g, a), stored."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("g").alias("id"))).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("text is not null")
    texts = work.keep(texts.join(wanted.hint("merge"), "id"), "texts")
    work.release()
    return texts


def linked(members: DataFrame, hubs: DataFrame, texts: DataFrame, width: int, percent: int, work: Scratch, name: str) -> DataFrame:
    """Links (a, b) of members (g, a) with the first of the hubs (g, h) that each is linked with, on whole sets; stored."""
    return work.keep(meet(members, hubs, texts, width, _first_link(percent), _LINK, work, name), f"{name}-links")


def labelled(signed: DataFrame, nodes: DataFrame, found: DataFrame, work: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id from prints, nodes and their components as of key_members() and connected_components()."""
    labels = nodes.select("print", "id").join(found.withColumnRenamed("node", "id"), "id", "left").select("print", F.coalesce("component", "id").alias("component_id"))
    labels = work.keep(labels, "labels")
    alone = signed.where("print is null or doc_id is null").withColumn("component_id", F.col("doc_id"))
    out = signed.where("print is not null and doc_id is not null").join(labels, "print").select(*signed.columns, "component_id").unionByName(alone)
    return out.select("doc_id", "n_shingles", "component_id")


def link_signed(docs: DataFrame, signed: DataFrame, own: str, width: int, percent: int, work: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id for documents whose links all share a key.

    signed, own: as key_members() takes them.  near_duplicates() says how keys become links.
    """
    signed, nodes, members = key_members(signed, own, work)
    pairs = work.keep(by_center(members, work), "pairs")
    for done in ("members", "centers"):
        work.drop(done)
    work.release()

    hubs = pairs.select("g", F.col("g").alias("h")).distinct()
    texts = texts_of(docs, pairs, work)
    seen = work.keep(meet(pairs, hubs, texts, width, _compare, _SEEN, work, "compare"), "seen")
    work.release()
    groups = _Groups(seen, texts, width, percent, work)
    found = connected_components(groups.links(), work, "first")

    def link(members: DataFrame, hubs: DataFrame, name: str) -> DataFrame:
        return linked(work.keep(members, f"{name}-in"), hubs, texts, width, percent, work, name)

    links, mixed = [], groups.place(found, "at")
    for k, (first, last) in enumerate(_ROUNDS, 1):
        big = mixed.where(F.col("many") > _SMALL)
        open_ = work.keep(big.where("open").select(F.col("b").alias("g"), "a").distinct(), f"open-{k}")
        waiting = open_.count()
        if not waiting:
            break
        links.append(link(open_, groups.nearest(big, first, last), f"round-{k}"))
        many = links[-1].count()
        if many:
            mixed = groups.merge(mixed, found, links[-1], f"at-{k}")
        if many * 10 < waiting:
            break
    left = groups.direct(mixed)
    if not mixed.where((F.col("many") > _SMALL) & F.col("open")).isEmpty():
        left = left.unionByName(groups.by_differences(mixed))
    left = work.keep(left.select(F.col("b").alias("g"), "a").distinct(), "left")
    if not left.isEmpty():
        links.append(link(left, left.select("g", F.col("g").alias("h")).distinct(), "late"))
    if links:
        stars = found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        for more in links:
            stars = stars.unionByName(more)
        found = connected_components(stars, work, "second")

    return labelled(signed, nodes, found, work)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, bands: int = 32, rows: int = 4) -> DataFrame:
    """Classes of documents linked by 100 * |A & B| >= percent * |A | B| on sets of word shingles.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable) and
    kept (doc_id = component_id), one row for each row of docs.

    1. A fast similarity sketch, whose coordinates make the bands, and a print of the whole set for each
       document; documents with one print are one node, their smallest doc_id.
    2. Nodes that share a band are a bucket; its centre is the node whose bands are the most shared, which
       in a group of copies is one close to what they were copied from.  Every node is compared with the centres of its
       buckets, on whole sets: n comparisons for n nodes.
    3. Where the nodes of one centre still span several components, those that it leaves open meet each of a small group, or,
       in a larger one, the nodes nearest to the centre in a few rounds and then, exactly, all that share enough
       of their differences from the centre.  No link between two nodes of one bucket is lost.

    At the threshold a pair shares no band with probability
    (1 - 0.75**4)**32 = 5e-6.  Null, empty and blank texts have no shingles and
    stay alone.  Repeated doc_ids are one document if their texts agree; with
    different texts, their links count for all of them.  Null doc_ids are
    kept as they are, unlinked.  An empty table gives no rows.  Only doc_id and text are read, so other
    columns may have any name.
    """
    work = Scratch(docs.sparkSession, "near")
    out = link_signed(docs, work.keep(sketch_documents(docs, width, bands, rows), "signed"), "signed", width, percent, work)
    out = work.keep(out.withColumn("kept", F.col("doc_id") == F.col("component_id")), "out")
    work.drop_all_but("out")
    return out


def keep_one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, with their own columns, whose document stands for its class; a repeated row stays once.

    Texts are shuffled once, by doc_id.  Rows without a doc_id are linked with nothing and stay.
    """
    gone = near_duplicates(docs, **how).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    known = docs.where("doc_id is not null")
    left = known.join(gone, known["doc_id"].cast("long") == F.col("__gone"), "left_anti")
    again = F.lag(F.struct("text")).over(Window.partitionBy("doc_id").orderBy("text"))
    once = left.withColumn("__again", again.eqNullSafe(F.struct("text"))).where("not __again").drop("__again")
    return once.unionByName(docs.where("doc_id is null"))
