"""A manifest of the dataset: a Merkle tree for each language, proofs for every document, a check of them.

A document's leaf is the digest of its fields. Leaves of one language ascend by key; every two
consecutive nodes become a node of the next level (the last run may be one node alone), until one is
left, the language's subroot. Subroots in the order of languages are the leaves of one last tree.

A node is labelled with the interval of leaf ranks it covers, ``lo`` to ``hi`` at a ``level``. Trees
grow in bands of ``BAND`` levels. In a band, the nodes of the lowest level fall into blocks of
``2^BAND`` neighbours, the bucket ``lo >> (level of the band + BAND)``; a block becomes the nodes above
it, each with the run it was made of. Ancestors are attached by a containment join within the
bucket: a node's interval lies in that of its ancestor. Of an ancestor's run, what remains after the
interval of the node is taken away are the siblings at that level. A block's own path, from the
bands above, follows for all its members, so a leaf meets ``BAND`` ancestors in its block and never
the whole tree; no block has more than ``2^BAND`` members however large a language is.

Ranks come from a sort by ranges over keys and a stored row number, so rows with equal keys can be cut
apart anywhere; rows are numbered within a piece and pieces are counted up.

Defined results: a null field counts as ``-`` in the leaf; a null language is a language of its own and
comes first; a null key ranks first in its language and is never tampered with; rows of equal key rank
by leaf, and exact repeats are leaves of their own with equal digests; an empty text is a field of
length 0; a text of any length is hashed as a whole; an empty table gives an empty result. Other
columns play no part, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.llm.frames import store

BAND, TAMPERED = 6, 7
FIELDS, COUNTED = ("doc_id", "source", "lang", "n_chars", "text"), "n_chars"
HASH_BITS = 256
# Partition and row number within it, as monotonically_increasing_id packs them.
PIECE_BITS = 33
RUN = "array<struct<lo: bigint, hi: bigint, digest: string>>"
PATH = "array<struct<level: int, before: string, after: string>>"
MADE = f"array<struct<level: int, lo: bigint, hi: bigint, run: {RUN}>>"


def digest(text: Column) -> Column:
    return F.sha2(text, HASH_BITS)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, key="doc_id", lang="lang", fields=FIELDS, counted=COUNTED) -> DataFrame:
    """``tree, doc_id, leaf, tampered, ordinal`` as a stored table; ``tampered`` is null if equal to the leaf."""

    def leaf(changed: bool) -> Column:
        values = [F.col(f).cast("decimal(38,0)") + 1 if changed and f == counted else F.col(f) for f in fields]
        return digest(F.concat(*map(field, values)))

    hit = F.col(counted).isNotNull() & (F.crc32(F.col(key).cast("string")) % TAMPERED == 0)
    rows = docs.select(
        # A language starts with =, which sorts after the - of none; the rest sorts by its bytes.
        F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("-")).alias("tree"),
        F.col(key).cast("long").alias("doc_id"), leaf(False).alias("leaf"), F.when(hit, leaf(True)).alias("tampered"),
    )
    return store(rows.withColumn("ordinal", F.monotonically_increasing_id()), "leaves")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``lo``, the rank in its ``tree``, and ``n``, the tree's size. ``rows`` is a stored table."""
    by = ["tree", *order]
    spread = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = store(spread.withColumn("place", F.monotonically_increasing_id()), "ranked")
    piece = F.shiftright("place", PIECE_BITS)
    # One row for each piece of a tree: as many as the sort has partitions, and one a tree.
    pieces = placed.groupBy("tree", piece.alias("piece")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("tree")
    before = F.sum("rows").over(whole.orderBy("piece")) - F.col("rows") - F.col("first")
    pieces = pieces.select("tree", "piece", before.alias("shift"), F.sum("rows").over(whole).alias("n"))
    numbered = placed.withColumn("piece", piece).join(pieces, ["tree", "piece"])
    return numbered.withColumn("lo", F.col("place") + F.col("shift")).drop("place", "piece", "shift")


def height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``: the bits of ``n - 1``."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _made(digests: Column, base: int, levels: Column) -> Column:
    """All nodes above the sorted nodes of one block, level by level, each with its run."""

    def grow(state: Column, step: Column) -> Column:
        nodes = state["nodes"]
        places = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
        runs = F.transform(places, lambda i: F.slice(nodes, i * 2 + 1, 2))

        def node(run: Column) -> list[Column]:
            return [run[0]["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi")]

        above = F.transform(runs, lambda run: F.struct(*node(run), digest(F.array_join(run["digest"], "")).alias("digest")))
        labelled = F.transform(runs, lambda run: F.struct((step + base).alias("level"), *node(run), run.alias("run")))
        return F.struct(above.alias("nodes"), F.concat(state["made"], labelled).alias("made"))

    steps = F.slice(F.array(*[F.lit(i) for i in range(1, BAND + 1)]), F.lit(1), levels)
    empty = F.struct(digests.alias("nodes"), F.array().cast(MADE).alias("made"))
    return F.aggregate(steps, empty, grow)


def grown(members: DataFrame, base: int) -> DataFrame:
    """From ``tree, block, lo, hi, digest, n``: each block's nodes ``made`` above it, and its topmost ``nodes``."""
    levels = F.least(F.lit(BAND), height(F.col("n")) - base)
    blocks = members.groupBy("tree", "block", "n").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("nodes"))
    return blocks.select("tree", "block", "n", _made(F.col("nodes"), base, levels).alias("grown")).select("tree", "block", "n", "grown.*")


def with_ancestors(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members with ``path``: for each level of the band, the siblings before and after.

    The join's partitions, by tree and block, also serve the grouping by member.
    """
    own, above = members.alias("m"), nodes.alias("p")
    inside = (F.col("m.tree") == F.col("p.tree")) & (F.col("m.block") == F.col("p.block"))
    inside &= (F.col("p.lo") <= F.col("m.lo")) & (F.col("m.hi") <= F.col("p.hi"))

    def siblings(side) -> Column:
        return F.array_join(F.filter("p.run", side)["digest"], "")

    step = F.struct(
        F.col("p.level").alias("level"),
        siblings(lambda kid: kid["hi"] < F.col("m.lo")).alias("before"),
        siblings(lambda kid: kid["lo"] > F.col("m.hi")).alias("after"),
    )
    joined = own.join(above, inside, "left").select("m.*", F.when(F.col("p.level").isNotNull(), step).alias("step"))
    return joined.groupBy(*members.columns).agg(F.array_sort(F.collect_list("step")).alias("path"))


def planted(rows: DataFrame, order: list[str], digest_of: str) -> list[tuple[DataFrame, DataFrame, DataFrame]]:
    """For each band, its members, the nodes above them and ``tree, block, top`` of trees that end there.

    ``rows`` is a stored table with ``tree``; bands are as many as the highest tree needs.
    """
    at = ranked(rows, order).withColumn("hi", F.col("lo")).withColumn("digest", F.col(digest_of))
    at = store(at, "members")
    bands, base, left = [], 0, True
    while left:
        members = at.withColumn("block", F.shiftright("lo", base + BAND))
        blocks = store(grown(members, base), "blocks")
        base += BAND
        tops = blocks.select("tree", "block", "n", F.inline("nodes"))
        ended = height(F.col("n")) <= base
        nodes = blocks.select("tree", "block", F.inline("made"))
        bands.append((members, nodes, tops.filter(ended).select("tree", "block", F.col("digest").alias("top"))))
        at = tops.filter(~ended).select("tree", "n", "lo", "hi", "digest")
        left = not at.isEmpty()
    return bands


def tops_of(bands: list) -> DataFrame:
    """``tree, top``."""
    return reduce(DataFrame.unionByName, (ended for _, _, ended in bands)).drop("block")


def with_paths(bands: list, beyond: DataFrame) -> DataFrame:
    """The rows trees were planted on, each with its ``path`` to the top and on as ``beyond`` has it.

    ``beyond`` has one row a tree: ``tree, path`` and what else is to go down to every row.
    """
    carried = [c for c in beyond.columns if c not in ("tree", "path")]
    further = None
    for number, (members, nodes, ended) in reversed(list(enumerate(bands))):
        here = ended.join(beyond, "tree").select("tree", "block", F.col("path").alias("rest"), "top", *carried)
        if further is not None:
            here = here.unionByName(further)
        whole = with_ancestors(members, nodes).join(here, ["tree", "block"])
        rows = whole.withColumn("path", F.concat("path", "rest")).drop("rest")
        # To the band below, a member is the top of a block.
        below = F.shiftright("lo", BAND * number).alias("block")
        further = rows.select("tree", below, F.col("path").alias("rest"), "top", *carried)
    return rows


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["before"], node, step["after"])))


def manifest(docs: DataFrame, key="doc_id", lang="lang", fields=FIELDS, counted=COUNTED) -> DataFrame:
    """``doc_id, lang, leaf, subroot, root, path, proof_sha256, folded_root, verified`` for every row.

    ``path`` holds the siblings ``before`` and ``after`` at each ``level``, first those in the tree of
    the language, then those among subroots.
    """
    bands = planted(leaves(docs, key, lang, fields, counted), ["doc_id", "leaf", "ordinal"], "leaf")
    # The last tree: one row a language.
    subroots = store(tops_of(bands).select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("top").alias("subroot")), "subroots")
    over = planted(subroots, ["of"], "subroot")
    end = tops_of(over).select("tree", F.array().cast(PATH).alias("path"))
    beyond = with_paths(over, end).select(F.col("of").alias("tree"), "path", F.col("top").alias("root"))
    rows = with_paths(bands, store(beyond, "beyond")).withColumnRenamed("top", "subroot")
    sides = F.transform("path", lambda step: F.concat(step["before"], step["after"]))
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select(
        "doc_id", F.when(F.col("tree") != "-", F.substring("tree", 2, 1 << 30)).alias("lang"), "leaf", "subroot", "root", "path",
        digest(F.array_join(sides, "")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
