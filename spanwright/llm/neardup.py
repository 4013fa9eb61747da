"""Near-duplicates: bottom-k sketches from one hash function.

1. Every text becomes the sorted set of its shingle hashes; its ``K`` smallest
   are its sketch, and a 128-bit digest of the set names its class of copies.
   Only one text of each class goes on.
2. Inverted lists of the retained values generate overlaps.  Two sets of
   Jaccard 0.75 or more share many of the values in the bottom k of their
   union: of k = 64 at least 24, but for a chance under 3 in 10**9 (the tail
   of the hypergeometric distribution), and all of the shared values if the
   sketches are whole sets.  So it is enough to list, for each set, all but
   ``t - 1`` of its values, rarest first: a pair that qualifies still meets in
   a list.  Values that only one class has need no list, and passages that
   very many texts share come last and are mostly left out.
3. A list's members are first paired with its smallest one only (a star), so a
   list of thousands of copies makes as many pairs as it has members.  The
   union-sketch estimate drops pairs that can't qualify: it is taken on deeper
   sketches of the same hash function, the ``DEEP`` smallest values of the
   texts that are in some pair.  Where both are whole sets, which they are for
   most texts, it is the exact Jaccard; else the full sets are made and the
   exact Jaccard verifies.  What is verified is joined to components.
4. Where members of a list, but its head, are in different components after
   that, inverted lists of their deep sketches generate the pairs that remain,
   again all but the last values, but as many as the sizes of both sides
   demand.  A copy that is too far from its star's centre has its own rare
   values there, and meets only those that share one.  Only members of
   different components are paired, and a long list is dealt out in pairs of
   blocks of ``BLOCK`` members, so no task has more than that.  The same
   estimate and verification follow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.llm.common import BROADCAST_ROWS, Tables, bounded_batches, checked_broadcast, cut, rows_of, tasks_for
from spanwright.llm.components import connected_components
from spanwright.llm.shingles import WordHashes, shingle_set

K = 64
#: Of the K values of a union's sketch that both sides hold at least.
SHARED = 24
#: The same for the deeper sketches; a chance under 2 in 10**10.
DEEP, DEEP_SHARED = 1024, 680
PERCENT = 75
#: Members of a list that one task pairs with as many others.
BLOCK = 256
#: Rows and values of an Arrow batch that is sent back; sets of long texts are large.
ROWS, VALUES = 256, 1 << 20


def _sketches(batches, k: int):
    words = WordHashes()
    for batch in batches:
        ids, texts, hashes = batch.column(0), batch.column(1), batch.column(2)
        for start in range(0, len(ids), 4096):
            size, high, low, sketch, offsets = [], [], [], [], [0]
            for text in texts.slice(start, 4096):
                found = shingle_set(text.as_py(), words)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                size.append(len(found))
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                sketch.append(found[:k].copy())
                offsets.append(offsets[-1] + len(sketch[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(start, 4096),
                    hashes.slice(start, 4096),
                    pa.array(size, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sketch) if sketch else [], pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "high", "low", "sketch"],
            )


def _sets(batches, k: int | None):
    """(class_id, n, shingles): the ``k`` smallest shingle hashes of each text, or all."""
    words = WordHashes()

    def batch_of(ids: list, sizes: list, sets: list) -> pa.RecordBatch:
        offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sets), pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), values], names=["class_id", "n", "shingles"])

    for batch in batches:
        ids, sizes, sets, held = [], [], [], 0
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            found = shingle_set(text.as_py(), words)
            ids.append(key.as_py()), sizes.append(len(found)), sets.append(found[:k].copy())
            held += len(sets[-1])
            if len(ids) >= ROWS or held >= VALUES:
                yield batch_of(ids, sizes, sets)
                ids, sizes, sets, held = [], [], [], 0
        if ids:
            yield batch_of(ids, sizes, sets)


def _least_shared(n: Column, percent: int, shared: int) -> Column:
    return F.least(F.ceil(n * percent / 100).cast("int"), F.lit(shared))


def _side(frame: DataFrame, name: str) -> DataFrame:
    return frame.select(F.col("class_id").alias(name), F.col("n").alias(f"{name}_n"), F.col("shingles").alias(f"{name}_shingles"))


def _both_sides(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with both sides' sets, if the sizes allow the Jaccard."""
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    return pairs.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b").filter(sizes)


def _links(pairs: DataFrame, deep: DataFrame, texts: DataFrame, tables: Tables, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets reach the Jaccard in percent.

    The union's deep sketch decides where both sides are whole sets; elsewhere
    it drops what can't qualify, and full sets decide.
    """
    whole = (F.col("a_n") <= DEEP) & (F.col("b_n") <= DEEP)
    both = F.size(F.array_intersect("a_shingles", "b_shingles"))
    exact = both * 100 >= (F.col("a_n") + F.col("b_n") - both) * percent
    union = F.slice(F.sort_array(F.array_union("a_shingles", "b_shingles")), 1, DEEP)
    near = F.size(F.array_intersect(F.array_intersect("a_shingles", "b_shingles"), union)) >= DEEP_SHARED
    found = _both_sides(pairs, deep, percent).filter(F.when(whole, exact).otherwise(near)).select("a", "b", whole.alias("sure"))
    found = tables.keep(found)
    open_pairs = found.filter("not sure").select("a", "b")
    if not open_pairs.limit(1).count():
        return found
    ids = tables.keep(open_pairs.select(F.col("a").alias("id")).union(open_pairs.select("b")).distinct())
    full = rows_of(texts, ids, "id").mapInArrow(lambda batches: _sets(batches, None), "class_id long, n long, shingles array<long>")
    full = tables.keep(full)
    verified = _both_sides(open_pairs, full, percent).filter(exact).select("a", "b")
    links = tables.keep(found.filter("sure").select("a", "b").union(verified))
    tables.drop(found, ids, full)
    return links


def _remaining(members: DataFrame, tables: Tables, percent: int) -> DataFrame:
    """Pairs (a, b) of members (class_id, n, root, shingles: the deep sketch) in
    different components that may qualify, by lists of the sketches' values.

    Two whole sets of na and nb values qualify with t / (1 + t) * (na + nb)
    common ones or more, and a larger union's sketch with ``DEEP_SHARED``; so
    they meet in the values that both hold before the last ones of that number,
    rarest first.  Sizes go by narrow bands, and a set is listed for each band
    of partners with just the values needed there.
    """
    share = percent / 100
    step = np.log(1.01)
    band = lambda size: F.floor(F.log(size.cast("double")) / step).cast("int")
    values = members.select("class_id", "n", "root", F.size("shingles").alias("held"), F.explode("shingles").alias("value"))
    # A list's bands are few: as many as there are sizes, on a scale of hundredths.
    common = (
        values.groupBy("value")
        .agg(F.count("*").alias("lists"), F.min("root").alias("r"), F.max("root").alias("s"), F.collect_set(band(F.col("n"))).alias("bands"))
        .filter("lists > 1")
    )
    of_class = Window.partitionBy("class_id")
    position = F.row_number().over(of_class.orderBy("lists", "value")) + F.col("held") - F.count("*").over(of_class)
    listed = values.join(common, "value").withColumn("position", position).filter("r < s")
    # The largest partner for which a value at this position is needed.
    exact = F.least((1 + share) / share * (F.col("n") - F.col("position") + 1) - F.col("n"), F.col("n") / share, F.lit(float(DEEP)))
    sketched = (F.col("position") <= F.col("held") - DEEP_SHARED + 1) & (F.col("n") / share > DEEP)
    most = F.when(sketched, F.col("n") / share).when(F.col("n") <= DEEP, exact) + 1e-6
    least = F.greatest(F.col("n") * share - 1e-6, F.lit(1.0))
    partners = F.when(most >= least, F.array_intersect("bands", F.sequence(band(least), band(most))))
    lists = listed.select("value", "class_id", "root", band(F.col("n")).alias("band"), F.explode(partners).alias("other"))
    keyed = tables.keep(lists.select("value", F.least("band", "other").alias("low"), F.greatest("band", "other").alias("high"), "band", "class_id", "root"))
    few, sides = tasks_for(keyed.count()), ["value", "low", "high"]
    # Lists that could give a pair, and the number of blocks of their members.
    counts = (
        keyed.groupBy(sides)
        .agg(F.count("*").alias("rows"), F.min("root").alias("r"), F.max("root").alias("s"), F.min("band").alias("p"), F.max("band").alias("q"))
        .filter("r < s and p = low and q = high")
        .select(*sides, F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    dealt = keyed.join(counts, sides).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    key = [*sides, "i", "j"]
    left = dealt.filter("band = low").select(*sides, F.col("block").alias("i"), each.alias("j"), F.col("class_id").alias("a"), F.col("root").alias("a_root")).coalesce(few)
    right = dealt.filter("band = high").select(*sides, F.col("block").alias("j"), each.alias("i"), F.col("class_id").alias("b"), F.col("root").alias("b_root")).coalesce(few)
    met = left.join(right, key).filter("a_root <> b_root and (low < high or a < b)")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, percent: int = PERCENT, shared: int = SHARED, text_hash: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``documents``.

    ``documents`` needs a long key and a text; other columns are ignored.
    Texts are linked if their shingle sets have a Jaccard of ``percent`` or
    more, and a component is what links reach; ``component_id`` is its
    smallest key, and that row is kept.  A null or blank text has no shingles
    and is linked with nothing.  Equal sets always lie in one component, so
    ties need no rule.  Rows that repeat a key and its text are the same document
    and get equal results; those of one key and different texts are linked and
    kept each by its own text, and of a component's smallest key one text is
    kept.  A null key is never linked: its component is null, and it is kept.
    An empty table gives an empty table.  With ``text_hash``, a column of that
    name follows: the xxhash64 of the text, which tells a key's texts apart.
    The result is checkpointed; the tables between the steps are deleted.
    """
    body = F.col(f"`{text}`")
    texts = bounded_batches(documents).select(F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_hash"))
    with Tables(documents.sparkSession) as tables:
        return cut(_found(texts, tables, k, percent, shared, text_hash))


def _found(texts: DataFrame, tables: Tables, k: int, percent: int, shared: int, text_hash: bool) -> DataFrame:
    schema = "doc_id long, text_hash long, n_shingles long, high long, low long, sketch array<long>"
    base = tables.keep(texts.mapInArrow(lambda batches: _sketches(batches, k), schema))
    rows = base.count()
    n = tasks_for(rows)
    # What follows and is broadcast has a row for each document at most.
    small = F.broadcast if rows <= BROADCAST_ROWS else checked_broadcast
    rows_of_key = base.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("text_hash").alias("p"), F.max("text_hash").alias("q"))
    repeated, several = rows_of_key.coalesce(n).agg(F.coalesce(F.max(F.col("n") > 1), F.lit(False)), F.coalesce(F.max(F.col("p") != F.col("q")), F.lit(False))).first()
    # Texts that share a key get keys of their own: hashes, so that another key
    # is met by chance about once in 2**64 pairs.
    if several:
        marked = tables.keep(rows_of_key.filter("p <> q").select("doc_id", F.lit(True).alias("several")))
        of_text = F.when(F.col("several"), F.xxhash64("doc_id", "text_hash")).otherwise(F.col("doc_id"))
        base, texts = (f.join(small(marked), "doc_id", "left").withColumn("id", of_text).drop("several") for f in (base, texts))
    else:
        base, texts = (f.withColumn("id", F.col("doc_id")) for f in (base, texts))
    texts = texts.select("id", "text")
    some = base.filter("n_shingles > 0 and doc_id is not null")
    classes = tables.keep(some.groupBy("high", "low").agg(F.min("id").alias("class_id"), (F.count("*") > 1).alias("copied")).coalesce(n))
    heads = rows_of(some, classes.select(F.col("class_id").alias("id")), "id", small)
    heads = (heads.dropDuplicates(["id"]) if repeated else heads).select(F.col("id").alias("class_id"), F.col("n_shingles").alias("n"), "sketch")

    values = heads.select("class_id", "n", F.size("sketch").alias("held"), F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("lists")).filter("lists > 1")
    of_class = Window.partitionBy("class_id")
    position = F.row_number().over(of_class.orderBy("lists", "value")) + F.col("held") - F.count("*").over(of_class)
    postings = tables.keep(
        values.join(common, "value")
        .withColumn("position", position)
        .filter(F.col("position") <= F.col("held") - _least_shared(F.col("n"), percent, shared) + 1)
        .select("value", "class_id")
    )
    n = tasks_for(postings.count())
    centres = postings.groupBy("value").agg(F.min("class_id").alias("head"), F.max("class_id").alias("last")).filter("head < last").drop("last")
    placed = tables.keep(postings.join(centres, "value").filter("class_id <> head").coalesce(n))
    tables.drop(postings)
    star = tables.keep(placed.select(F.col("head").alias("a"), F.col("class_id").alias("b")).distinct().coalesce(n))
    needed = tables.keep(star.select(F.col("a").alias("id")).union(star.select("b")).distinct().coalesce(n))
    deep = rows_of(texts, needed, "id", small).mapInArrow(lambda batches: _sets(batches, DEEP), "class_id long, n long, shingles array<long>")
    deep = tables.keep(deep.dropDuplicates(["class_id"]) if repeated else deep)
    links = _links(star, deep, texts, tables, percent)
    first = connected_components(links.select("a", "b"), tables)
    tables.drop(star, needed, links)

    # What remains: members of one list, but its head, in different components.
    roots = small(first.withColumnRenamed("node", "class_id"))
    placed = placed.select("value", "class_id").join(roots, "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    mixed = placed.groupBy("value").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r < s").select("value")
    members = tables.keep(placed.join(mixed, "value", "left_semi").select("class_id", "root").distinct().coalesce(n))
    pairs = tables.keep(_remaining(deep.join(small(members), "class_id"), tables, percent))
    links = _links(pairs, deep, texts, tables, percent)
    roots = connected_components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links.select("a", "b")), tables)

    classed = base.select("doc_id", "id", "text_hash", "n_shingles", "high", "low")
    copies = classes.filter("copied").select("high", "low", "class_id")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classed = classed.join(small(copies), ["high", "low"], "left").withColumn("class_id", F.when(linked, F.coalesce("class_id", "id")))
    found = classed.join(small(roots.withColumnRenamed("node", "class_id")), "class_id", "left").withColumn("component", F.coalesce("root", "class_id"))
    head, head_id = F.coalesce("component", "doc_id"), F.coalesce("component", "id")
    if several:
        # A root may be a text's own key; the smallest key comes with its text.
        smallest = found.filter("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "id")).alias("head"))
        found = found.join(smallest, "component", "left")
        head, head_id = F.coalesce("head.doc_id", "doc_id"), F.coalesce("head.id", "id")
    return found.select(
        "doc_id",
        "n_shingles",
        head.alias("component_id"),
        F.coalesce(F.col("id") == head_id, F.lit(True)).alias("kept"),
        *(["text_hash"] if text_hash else []),
    )
