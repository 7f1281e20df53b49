"""Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf. The leaves of a group (a source) in their order are the
lowest level of the group's tree: while more than one node is left, every FAN
consecutive ones become one node of the next level. What remains are the
groups' subroots, which in their order make up a last tree with the root. The
levels are built by grouping, one shuffle of ever fewer digests each.

Proofs are made for PART consecutive leaves at once. Such a part works out which
siblings on all paths to the root it can't derive from its own leaves, each
once (the octopus of paths has one body). These few nodes are fetched by one
join; the part then derives the interior nodes its leaves share and expands the
proof of each single leaf without further traffic.

A node has the coordinates (g, level, i): its group's number, or TOP for the
tree over the groups, its level and its place there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialize
from demandspark.sources.ids import with_consecutive_id

FAN = 16
PART = 4096        # leaves in one part
SALTS = 16         # copies of what many rows meet in a join
SHARED_LEVEL = 3   # nodes from this level on are asked for by many parts
TOP = -1


@dataclass
class Manifest:
    """leaves: the given columns, digest, g, i, size (leaves of the group), n (place over all groups);
    nodes: g, level, i, digest; groups: how many; root: hex digits, None without leaves."""
    leaves: DataFrame
    nodes: DataFrame
    groups: int
    root: str | None


def encode(*columns: Column) -> Column:
    """The values as one text from which they can be told apart: ``-`` for null, else their
    bytes after their length and a colon."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.concat(*[one(c) for c in columns])


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _climb(level: DataFrame, first: int = 0) -> list[DataFrame]:
    """All levels of the trees whose lowest nodes are ``level`` (g, i, size, digest), each written."""
    out, k = [], first
    while True:
        out.append(level.withColumn("level", F.lit(k)))
        more = level.where("size > 1")
        if more.isEmpty():
            return out
        # a run holds FAN nodes at most
        run = F.sort_array(F.collect_list(F.struct("i", "digest")))
        joined = F.array_join(F.transform(run, lambda x: F.lower(F.hex(x["digest"]))), "")
        level = materialize(
            more.groupBy("g", F.floor(F.col("i") / FAN).alias("i"))
            .agg(F.ceil(F.max("size") / FAN).alias("size"), digest(joined).alias("digest")), "merkle-level")
        k += 1


def build_manifest(leaves: DataFrame, group: str, order: str) -> Manifest:
    """The trees over rows with a column ``digest`` (32 bytes).

    Groups are ordered by value and leaves by ``order`` within them (null
    first, strings bytewise; equal ones by digest). Further columns are kept
    unless they are named g, i, size, n or _salt. No rows make no nodes.
    """
    numbered = materialize(with_consecutive_id(leaves, [group, order, "digest"], "n", start=0), "merkle-leaves")
    groups = numbered.groupBy(group).agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("size"))
    groups = materialize(with_consecutive_id(groups, ["first"], "g", start=0).withColumnRenamed(group, "_group"),
                         "merkle-groups")
    # a group may hold most rows: they are dealt over SALTS copies of its row
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = materialize(
        numbered.withColumn("_salt", F.pmod("n", F.lit(SALTS)).cast("int"))
        .join(salted, F.col(group).eqNullSafe(F.col("_group")) & (numbered["n"] % SALTS == salted["_salt"]))
        .select(*leaves.columns, "n", "g", (F.col("n") - F.col("first")).alias("i"), "size"), "merkle-placed")
    n_groups = groups.count()
    levels = _climb(placed.select("g", "i", "size", "digest"))
    subroots = reduce(DataFrame.unionByName, [x.where("size = 1") for x in levels])
    top = _climb(subroots.select(F.lit(TOP).cast("long").alias("g"), F.col("g").alias("i"),
                                 F.lit(n_groups).cast("long").alias("size"), "digest"))
    nodes = reduce(DataFrame.unionByName, [*levels, *top]).select("g", "level", "i", "digest")
    root = top[-1].where("size = 1").select(F.lower(F.hex("digest"))).first()
    return Manifest(placed, nodes, n_groups, root[0] if root else None)


def _levels(own: np.ndarray, n: int):
    """Per level below the root of n nodes: the places that are known, and the missing rest of their runs."""
    while n > 1:
        parents = np.unique(own // FAN)
        runs = (parents[:, None] * FAN + np.arange(FAN)).ravel()
        yield own, np.setdiff1d(runs[runs < n], own, assume_unique=True)
        own, n = parents, -(-n // FAN)


def missing_nodes(leaves: pd.DataFrame, groups: int) -> pd.DataFrame:
    """Coordinates of the fewest nodes from which, with these leaves, all their proofs follow."""
    rows = []
    trees = [(int(g), np.sort(x["i"].to_numpy()), int(x["size"].iloc[0])) for g, x in leaves.groupby("g")]
    trees.append((TOP, np.array([g for g, _, _ in trees]), groups))
    for g, own, n in trees:
        for level, (_, rest) in enumerate(_levels(own, n)):
            rows.extend((g, level, int(i)) for i in rest)
    return pd.DataFrame(rows, columns=["g", "level", "i"])


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _runs(known: dict[int, str], own: np.ndarray, n: int, fetched: dict, g: int) -> tuple[list[dict], str]:
    """Per level the joined digests of each run, by parent, and the root; interiors are derived."""
    levels = []
    for level, (at, rest) in enumerate(_levels(own, n)):
        known.update((int(i), fetched[g, level, int(i)]) for i in rest)
        by: dict[int, list[str]] = {}
        for i in sorted(known):
            by.setdefault(i // FAN, []).append(known[i])
        levels.append({p: "".join(x) for p, x in by.items()})
        known = {p: _hash(x) for p, x in levels[-1].items()}
    return levels, next(iter(known.values()))


def _path(levels: list[dict], i: int) -> list[tuple[str, int]]:
    """(run, offset of the node in it) from the place i up."""
    out = []
    for runs in levels:
        out.append((runs[i // FAN], 64 * (i % FAN)))
        i //= FAN
    return out


def expand_proofs(leaves: pd.DataFrame, fetched: pd.DataFrame, groups: int) -> pd.DataFrame:
    """Single proofs of the leaves of a part (g, i, size, digest, claimed) from the nodes fetched for it."""
    got = {(g, k, i): d.hex() for g, k, i, d in zip(*(fetched[c] for c in ("g", "level", "i", "digest")))}
    trees, subroots = {}, {}
    for g, x in leaves.groupby("g"):
        known = {int(i): d.hex() for i, d in zip(x["i"], x["digest"])}
        trees[g], subroots[int(g)] = _runs(known, np.sort(x["i"].to_numpy()), int(x["size"].iloc[0]), got, g)
    top, root = _runs(dict(subroots), np.array(sorted(subroots)), groups, got, TOP)
    above: dict[tuple[int, int], tuple[list, str]] = {}   # by parent: its path and the siblings along it
    rows = []
    for g, i, leaf, claimed in zip(*(leaves[c] for c in ("g", "i", "digest", "claimed"))):
        path = _path(trees[g], i) + _path(top, g)
        if (g, i // FAN) not in above:
            above[g, i // FAN] = path[1:], "".join(run[:o] + run[o + 64:] for run, o in path[1:])
        own = "".join(run[:o] + run[o + 64:] for run, o in path[:1])
        folded = (claimed if claimed is not None else leaf).hex()
        for run, o in path[:1] + above[g, i // FAN][0]:
            folded = _hash(run[:o] + folded + run[o + 64:])
        rows.append((leaf.hex(), subroots[int(g)], root, _hash(own + above[g, i // FAN][1]), folded, folded == root))
    return pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


PROOF = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(manifest: Manifest, leaves: DataFrame, key: str, claimed: str | None = None) -> DataFrame:
    """Proofs of some leaves of the manifest, checked against its root.

    leaves: rows of ``manifest.leaves``. ``claimed`` names a column with the
    digest to be proved in place of the leaf's own (null: the leaf's own); it
    is folded with the manifest's siblings. Returns key, leaf, subroot, root,
    proof_sha256 (of the siblings' hex digits, from the leaf up, left to
    right), folded_root and verified (it equals the root).
    """
    groups, root = manifest.groups, manifest.root
    # as text, since pandas holds a column of numbers with nulls as doubles
    own = leaves.select(F.col(key).cast("string").alias("key"), "g", "i", "size", "digest",
                        (F.col(claimed) if claimed else F.lit(None).cast("binary")).alias("claimed"),
                        F.floor(F.col("n") / PART).alias("part"))

    def wanted(pdf: pd.DataFrame) -> pd.DataFrame:
        out = missing_nodes(pdf, groups)
        out["part"] = pdf["part"].iloc[0]
        return out

    def often(c: DataFrame) -> Column:
        return (F.col("level") >= SHARED_LEVEL) | (F.col("g") == TOP)

    asked = (own.select("part", "g", "i", "size").groupBy("part")
             .applyInPandas(wanted, "g long, level int, i long, part long"))
    asked = asked.withColumn("salt", F.when(often(asked), F.pmod("part", F.lit(SALTS))).otherwise(0).cast("int"))
    nodes = manifest.nodes
    nodes = nodes.withColumn("salt", F.explode(
        F.when(often(nodes), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    fetched = asked.join(nodes, ["g", "level", "i", "salt"]).select("part", "g", "level", "i", "digest")

    def proofs(pdf: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        out = expand_proofs(pdf, got, groups)
        out.insert(0, "key", pdf["key"].to_numpy())
        # the part's own way to the root must end where the manifest does
        out["verified"] &= out["root"] == root
        return out

    kind = leaves.schema[key].dataType.simpleString()
    return (own.groupBy("part").cogroup(fetched.groupBy("part"))
            .applyInPandas(proofs, f"key string, {PROOF}")
            .withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key))


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, source, digest, claimed): the leaf of each row from doc_id, source, lang, n_chars and
    text; where ``tampered`` holds, claimed is the leaf of the row with the text's A-Z lower-cased."""
    kept = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.lit(None).cast("binary") if tampered is None else F.when(tampered, digest(encode(*kept, lower)))
    return docs.select("doc_id", "source", digest(encode(*kept, F.col("text"))).alias("digest"),
                       claimed.alias("claimed"))


def document_proofs(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Every row of docs (doc_id, source, lang, n_chars, text; other columns are ignored) as a leaf of
    a manifest by source, proved against its root (see ``prove``).

    Nulls are values of their own: a null source is the first group, a null
    doc_id the first leaf of its group. Repeated rows are leaves of their own,
    in the order of their digests. An empty table gives no rows.
    """
    manifest = build_manifest(document_leaves(docs, tampered), "source", "doc_id")
    return prove(manifest, manifest.leaves, "doc_id", "claimed")
