"""Trees: Newick text, neighbour joining, pruning and grafting.

A tree is small next to the data (a cluster or a backbone); many trees are handled as many rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import ship
from .alignments import PAIRS, base_planes, differences

EDGES = "tree_id string, node_id bigint, parent_id bigint, child_ord int, name string, branch_length double, is_tip boolean"
NEAR, ROWS, CELLS, FIRST = 16, 64, 1 << 20, 16  # nearest nodes kept for each; rows and cells computed at a time; rows looked at first
MATRIX = 2048  # so many tips have a matrix (32 MB) also where profiles are smaller
TASKS = 200  # clusters are dealt to so many tasks, or more
_TOKEN = re.compile(r"\s*(?:('(?:[^']|'')*')|([(),:;])|(\[[^\]]*\])|([^\s(),:;\[]+))")


@dataclass(eq=False)
class Node:
    name: str | None = None
    length: float | None = None
    children: list[Node] = field(default_factory=list)

    def walk(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.children))

    def tips(self) -> list[Node]:
        return [n for n in self.walk() if not n.children]


def parse_newick(text: str) -> Node:
    """The tree of a Newick text; comments in brackets are skipped."""
    root = node = Node()
    above: list[Node] = []
    wants_length = False
    for quoted, mark, comment, word in _TOKEN.findall(text):
        if comment:
            continue
        if mark == "(":
            child = Node()
            node.children.append(child)
            above.append(node)
            node = child
        elif mark == ",":
            if not above:
                raise ValueError("a comma outside brackets")
            node = Node()
            above[-1].children.append(node)
        elif mark == ")":
            if not above:
                raise ValueError("unbalanced brackets")
            node = above.pop()
        elif mark == ":":
            wants_length = True
        elif mark == ";":
            break
        elif wants_length:
            node.length, wants_length = float(word), False
        else:
            node.name = quoted[1:-1].replace("''", "'") if quoted else word
    if above:
        raise ValueError("unbalanced brackets")
    return root


def write_newick(root: Node) -> str:
    """Newick text of a tree; names with special characters are quoted."""
    done: dict[int, str] = {}
    for n in reversed(list(root.walk())):
        label = n.name or ""
        if re.search(r"[\s(),:;\[\]']", label):
            label = "'" + label.replace("'", "''") + "'"
        inside = "(" + ",".join(done[id(c)] for c in n.children) + ")" if n.children else ""
        done[id(n)] = inside + label + (f":{float(n.length)!r}" if n.length is not None else "")
    return done[id(root)] + ";"


def star(names: list[str]) -> str:
    """The fallback tree in which all tips hang on one node."""
    return write_newick(Node(children=[Node(n) for n in names]))


def edges_of(tree_id: str, root: Node) -> pd.DataFrame:
    nodes = list(root.walk())
    number = {id(n): i for i, n in enumerate(nodes)}
    rows = [(tree_id, 0, None, 0, root.name, root.length, not root.children)]
    rows += [(tree_id, number[id(c)], number[id(n)], k, c.name, c.length, not c.children) for n in nodes for k, c in enumerate(n.children)]
    return pd.DataFrame(rows, columns=["tree_id", "node_id", "parent_id", "child_ord", "name", "branch_length", "is_tip"]).astype({"parent_id": "Int64"})


def parse_trees(texts: DataFrame) -> DataFrame:
    """EDGES of rows (tree_id, newick)."""
    ship(texts.sparkSession)

    def run(frames):
        for frame in frames:
            for tree_id, newick in zip(frame["tree_id"], frame["newick"]):
                yield edges_of(tree_id, parse_newick(newick))

    return texts.select("tree_id", "newick").mapInPandas(run, EDGES)


def root_of(edges: pd.DataFrame) -> Node:
    """The tree of one tree's EDGES rows."""
    null = lambda v: None if pd.isna(v) else v
    nodes = {r.node_id: Node(null(r.name_), null(r.branch_length)) for r in edges.rename(columns={"name": "name_"}).itertuples()}
    root = None
    for r in edges.sort_values(["parent_id", "child_ord"]).itertuples():
        if pd.isna(r.parent_id):
            root = nodes[r.node_id]
        else:
            nodes[r.parent_id].children.append(nodes[r.node_id])
    return root


def write_trees(edges: DataFrame) -> DataFrame:
    """(tree_id, newick) of EDGES."""
    ship(edges.sparkSession)
    one = lambda frame: pd.DataFrame({"tree_id": [frame["tree_id"].iloc[0]], "newick": [write_newick(root_of(frame))]})
    return edges.groupBy("tree_id").applyInPandas(one, "tree_id string, newick string")


class Matrix:
    """Distances between nodes, held as a matrix: 8 bytes for each two."""

    def __init__(self, d: np.ndarray):
        self.d = d

    def sums(self) -> np.ndarray:
        return self.d.sum(axis=1)

    def rows(self, some: np.ndarray, n: int) -> np.ndarray:
        """A new array: how far some nodes are from each of the first n."""
        return self.d[some, :n]

    def join(self, i: int, j: int, n: int, gap: float) -> np.ndarray:
        """Nodes i < j, gap apart, are one in place i, the last of n takes place j: how far the new one was from each before."""
        d = self.d
        joined = (d[i, :n] + d[j, :n] - gap) / 2
        joined[[i, j]] = 0.0
        d[i, :n] = d[:n, i] = joined
        d[j, :n], d[:n, j] = d[n - 1, :n], d[:n, n - 1]
        d[j, j] = 0.0
        return joined


class Profiles:
    """Distances between nodes, computed of the mean of their sequences: memory is linear in the tips, no pair is held.

    The distance to a joined pair is the mean of the distances to both less half their own. So of nodes it is the mean number
    of differing columns, a product of mean columns, less an offset for each node. A, C, G and T are corners of a tetrahedron
    (product 3 of one with itself, -1 with another), what is none of these is 0, and known says which are.
    """

    def __init__(self, planes: np.ndarray):
        one, two, known = (np.unpackbits(p.view(np.uint8), axis=1).view(np.int8) for p in planes)
        one, two = known - 2 * (known & one), known - 2 * (known & two)
        varies = np.logical_or.reduce([x.min(axis=0) < x.max(axis=0) for x in (one, two, known)])
        one, two, known = one[:, varies], two[:, varies], known[:, varies]
        partly = known.min(axis=0) == 0
        self.all_known = 0.75 * float((~partly).sum())
        w = one.shape[1]
        self.weights = np.repeat([-0.25, 0.75], [3 * w, int(partly.sum())])
        self.means = np.empty((len(one), len(self.weights)))
        self.means[:, :w], self.means[:, w : 2 * w], self.means[:, 3 * w :] = one, two, known[:, partly]
        np.multiply(one, two, out=self.means[:, 2 * w : 3 * w])
        self.offsets = np.zeros(len(self.means))

    @staticmethod
    def width(planes: np.ndarray) -> int:
        """How many numbers a node has, at most."""
        return 4 * 64 * planes.shape[2]

    def sums(self) -> np.ndarray:
        return len(self.means) * self.all_known + self.means @ (self.weights * self.means.sum(axis=0))

    def rows(self, some: np.ndarray, n: int) -> np.ndarray:
        d = (self.means[some] * self.weights) @ self.means[:n].T
        d += self.all_known - self.offsets[some, None]
        d -= self.offsets[:n]
        return d

    def join(self, i: int, j: int, n: int, gap: float) -> np.ndarray:
        self.means[i] = (self.means[i] + self.means[j]) / 2
        self.offsets[i] = (self.offsets[i] + self.offsets[j] + gap) / 2
        joined = self.rows(np.array([i]), n)[0]
        joined[[i, j]] = 0.0
        self.means[j], self.offsets[j] = self.means[n - 1], self.offsets[n - 1]
        return joined


def joins(n: int, source: Matrix | Profiles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbour joining of a source's distances between n tips, which is used up; negative lengths become 0.

    What is joined, step by step, each length, and what is left at the top; tips are 0 to n - 1, the first joined pair is n.

    Of all pairs the one with least q = (n - 2) d - total - total is joined, of equal ones the first by place. Instead of
    computing all, each node keeps its NEAR nearest by d - total / (n - 2) among older nodes, and a bound of the others. A
    distance never changes while both nodes are there, and bounds fall by at most the largest rise of a total / (n - 2):
    rows are computed again only where their bound does not rule out the least pair. So the result is that of all pairs.
    """
    pairs, lengths, tips = np.empty((max(n - 3, 0), 2), np.int32), np.zeros(2 * n), n
    total = source.sums()
    ident = np.arange(n)  # a pair is kept by the node with the larger identity, the younger one
    place, value = np.zeros(2 * n, int), np.full(2 * n, -np.inf)  # by identity; value: total / (n - 2), no more there: -inf
    place[:n] = ident
    near, near_d = np.zeros((n, NEAR), np.int32), np.full((n, NEAR), np.inf)
    low, rest, drift = np.full(n, np.inf), np.full(n, np.inf), 0.0  # bounds of the near and of the others, drift not yet taken off

    def keep(some, d, u):
        """The nearest of some rows, whose pairs that others keep are inf."""
        v = d - u
        if d.shape[1] > NEAR:
            at = np.argpartition(v, NEAR, axis=1)[:, : NEAR + 1]
            rest[some], at = np.take_along_axis(v, at[:, NEAR:], 1)[:, 0] + drift, at[:, :NEAR]
        else:
            rest[some], at = np.inf, np.broadcast_to(np.arange(d.shape[1]), d.shape)
        near[some, : at.shape[1]], near_d[some, : at.shape[1]] = ident[at], np.take_along_axis(d, at, 1)
        near_d[some, at.shape[1] :] = np.inf
        low[some] = np.take_along_axis(v, at, 1).min(axis=1) + drift

    step = max(1, min(ROWS, CELLS // max(n, 1)))
    if n > 3:
        u = total / (n - 2)
        for i in range(0, n, step):
            some = np.arange(i, min(n, i + step))
            d = source.rows(some, some[-1] + 1)
            d[ident[: d.shape[1]] >= some[:, None]] = np.inf
            keep(some, d, u[: d.shape[1]])
        slack = 1e-10 * (1 + float(np.abs(u).max()))
    while n > 3:
        u = total[:n] / (n - 2)
        value[ident[:n]] = u
        bound = np.minimum(low[:n], rest[:n]) - u - drift
        found = (np.inf, n, n, 0.0)

        def least(found, q, some, others, d):
            m = float(q.min())
            if m > found[0] or m == np.inf:
                return found
            r, c = np.nonzero(q == m)
            a, b = np.minimum(some[r], others[r, c]), np.maximum(some[r], others[r, c])
            k = int(np.argmin(a * n + b))
            return min(found, (m, int(a[k]), int(b[k]), float(d[r[k], c[k]])))

        def may_be_least(bounds, some):
            """Whether rows may have a pair with less q, or one with the same that is first by place."""
            best = found[0] / (n - 2)
            return (bounds < np.inf) & (bounds <= best + slack) & ((bounds < best - slack) | (found[1] > 0) | (some < found[2]))

        some = np.argpartition(bound, FIRST)[:FIRST] if n > FIRST else np.arange(n)
        while len(some):
            d, others = near_d[some], place[near[some]]
            there = value[near[some]]
            low[some] = (d - there).min(axis=1) + drift
            q = np.where(np.isfinite(there), (n - 2) * d - total[others] - total[some, None], np.inf)
            found = least(found, np.round(q, 12), some, others, d)
            some_rest = rest[some] - u[some] - drift
            bound[some] = np.inf
            again = some[may_be_least(some_rest, some)]
            for part in (again[k : k + step] for k in range(0, len(again), step)):
                d = source.rows(part, n)
                d[ident[:n] >= ident[part, None]] = np.inf
                q = (n - 2) * d - total[:n]
                q -= total[part, None]
                found = least(found, np.round(q, 12, out=q), part, np.broadcast_to(np.arange(n), d.shape), d)
                keep(part, d, u)
            some = np.flatnonzero(may_be_least(bound, np.arange(n)))
            if len(some) > step:
                some = some[np.argsort(np.round(bound[some], 9), kind="stable")[:step]]
        _, i, j, gap = found
        half = gap / 2 + (total[i] - total[j]) / (2 * (n - 2))
        pairs[tips - n] = ident[[i, j]]
        lengths[ident[[i, j]]] = max(half, 0.0), max(gap - half, 0.0)
        joined = source.join(i, j, n, gap)
        total[:n] -= joined + gap
        total[i] = joined.sum()
        # the new node takes place i, the last one place j
        value[ident[[i, j]]] = -np.inf
        ident[i] = tips + tips - n
        for held in (joined, u, total, ident, near, near_d, low, rest):
            held[j] = held[n - 1]
        n -= 1
        place[ident[:n]] = np.arange(n)
        now = total[:n] / (n - 2)
        rise = now - u[:n]
        rise[i] = -np.inf
        drift += float(rise.max())
        joined[i] = np.inf
        keep(np.array([i]), joined[None, :n], now)
    d, top = source.rows(np.arange(n), n), ident[:n]
    if n == 3:
        a, b, c = d[0, 1], d[0, 2], d[1, 2]
        lengths[top] = np.maximum([(a + b - c) / 2, (a + c - b) / 2, (b + c - a) / 2], 0.0)
    elif n == 2:
        lengths[top] = d[0, 1] / 2
    return pairs, lengths, top


def joined_tree(names: list[str], pairs: np.ndarray, lengths: np.ndarray, top: np.ndarray) -> Node:
    """The tree of joins."""
    lengths = lengths.tolist()
    nodes = [Node(x, length) for x, length in zip(names, lengths)]
    for i, j in pairs.tolist():
        nodes.append(Node(None, lengths[len(nodes)], [nodes[i], nodes[j]]))
    if len(top) > 1:
        return Node(children=[nodes[i] for i in top.tolist()])
    nodes[0].length = None
    return nodes[0]


def neighbour_joining(names: list[str], d: np.ndarray, copy: bool = True) -> Node:
    """The neighbour-joining tree of a distance matrix; negative lengths become 0. An estimate, not a likelihood tree.

    The matrix, or a copy of it, is joined in place.
    """
    return joined_tree(names, *joins(len(names), Matrix(np.array(d, float) if copy else d)))


def sequence_tree(names: list[str], seqs: list[str]) -> Node:
    """The neighbour-joining tree of sequences' differences. Of many more tips than columns no matrix is made."""
    planes = base_planes(seqs)
    if len(names) > max(MATRIX, Profiles.width(planes)):
        return joined_tree(names, *joins(len(names), Profiles(planes)))
    every, d = np.arange(len(names)), np.empty((len(names),) * 2)
    step = max(1, PAIRS // (len(names) * max(1, planes.shape[2])))
    for i in range(0, len(names), step):
        d[i : i + step] = differences(planes, every[i : i + step], every)
    return joined_tree(names, *joins(len(names), Matrix(d)))


def nj_trees(distances: DataFrame, members: DataFrame, missing: float | None = None) -> DataFrame:
    """(cluster_id, n_tips, method, newick) for each cluster, whole.

    A pair that is not listed is `missing` apart, or else as far as the cluster's farthest. distances: cluster_id, a, b,
    distance; members: cluster_id, name. Fewer than three members give a star, and the method says so. A cluster's matrix is
    in one task (8 bytes a pair), so clusters are split before (clusters.split_oversize) where they may
    have tens of thousands of different sequences.
    """
    ship(members.sparkSession)

    def build(key, people, pairs):
        names = sorted(people["name"].astype(str))
        if len(names) < 3:
            return pd.DataFrame({"cluster_id": [key[0]], "n_tips": [len(names)], "method": ["star"], "newick": [star(names)]})
        at = pd.Series(np.arange(len(names)), index=names)
        far = missing if missing is not None else float(pairs["distance"].max()) if len(pairs) else 0.0
        d = np.full((len(names), len(names)), far)
        np.fill_diagonal(d, 0)
        known = pairs[pairs["a"].isin(at.index) & pairs["b"].isin(at.index)]
        i, j = at[known["a"]].to_numpy(), at[known["b"]].to_numpy()
        d[i, j] = d[j, i] = known["distance"].to_numpy(float)
        return pd.DataFrame({"cluster_id": [key[0]], "n_tips": [len(names)], "method": ["neighbour_joining"], "newick": [write_newick(neighbour_joining(names, d))]})

    kind = members.schema["cluster_id"].dataType.simpleString()
    left = members.select("cluster_id", F.col("name").cast("string").alias("name")).groupBy("cluster_id")
    right = distances.select(F.col("cluster_id").alias("of_cluster"), F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.col("distance").cast("double").alias("distance")).groupBy("of_cluster")
    return left.cogroup(right).applyInPandas(build, f"cluster_id {kind}, n_tips bigint, method string, newick string")


def sequence_trees(classes: DataFrame) -> DataFrame:
    """(cluster_id, n_tips, method, newick) as nj_trees gives of snp_distances, for each cluster, whole.

    classes: cluster_id, rep, seq. A cluster's distances are computed where its tree is built: what is shuffled are its
    sequences, not its pairs. Of a cluster of many more sequences than columns no matrix is held, but at most 32 bytes for
    each column of each sequence.
    """
    ship(classes.sparkSession)

    def build(key, people):
        people = people.assign(rep=people["rep"].astype(str)).sort_values("rep")
        names = people["rep"].tolist()
        if len(names) < 3:
            return pd.DataFrame({"cluster_id": [key[0]], "n_tips": [len(names)], "method": ["star"], "newick": [star(names)]})
        return pd.DataFrame({"cluster_id": [key[0]], "n_tips": [len(names)], "method": ["neighbour_joining"], "newick": [write_newick(sequence_tree(names, people["seq"].tolist()))]})

    kind = classes.schema["cluster_id"].dataType.simpleString()
    rows = classes.select("cluster_id", "rep", F.upper(F.coalesce("seq", F.lit(""))).alias("seq"))
    # a number, as few bytes are much work here: without one, clusters are put together in one task
    rows = rows.repartition(max(TASKS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "cluster_id")
    return rows.groupBy("cluster_id").applyInPandas(build, f"cluster_id {kind}, n_tips bigint, method string, newick string")


def backbone_tree(distances: DataFrame, representatives: DataFrame, missing: float = 1.0) -> DataFrame:
    """(cluster_id, n_tips, method, newick): one tree of all representatives, a star of fewer than three.

    distances: a, b, distance; representatives: representative. A pair that is not listed is `missing` apart.
    """
    one = F.lit("backbone").alias("cluster_id")
    return nj_trees(distances.select(one, "a", "b", "distance"), representatives.select(one, F.col("representative").alias("name")), missing)


def label(text: str | None) -> str:
    """As functions.names.normalize_label, for single names."""
    from ..functions.names import LABEL_ENDINGS

    text = (text or "").strip()
    if len(text) > 1 and text[0] == text[-1] and text[0] in "'\"":
        text = text[1:-1]
    for ending in LABEL_ENDINGS:
        text = text.removesuffix(ending)
    return text.replace(" ", "_")


def find_tip(root: Node, wanted: str, fuzzy: bool = False) -> Node | None:
    """A tip by exact name, by normalised name or, if fuzzy, by the only name that contains it or is inside it."""
    tips = root.tips()
    for test in (lambda t: t.name == wanted, lambda t: label(t.name) == label(wanted)):
        if found := [t for t in tips if test(t)]:
            return found[0]
    near = [t for t in tips if label(t.name) and (label(wanted) in label(t.name) or label(t.name) in label(wanted))] if fuzzy else []
    return near[0] if len(near) == 1 else None


def infer_representative(root: Node, backbone: set[str]) -> str | None:
    """The first tip that the backbone has too, else the first tip."""
    tips = [t.name for t in root.tips()]
    return next((t for t in tips if t in backbone), tips[0] if tips else None)


def prune(root: Node, tip: Node) -> Node | None:
    """The tree without a tip; a node left with one child is replaced by it, lengths added."""
    if root is tip:
        return None
    parent = {id(c): n for n in root.walk() for c in n.children}
    above = parent[id(tip)]
    above.children.remove(tip)
    if not above.children:
        return prune(root, above)
    if len(above.children) == 1:
        child = above.children[0]
        if above is root:
            child.length = None
            return child
        child.length = (child.length or 0.0) + (above.length or 0.0)
        siblings = parent[id(above)].children
        siblings[siblings.index(above)] = child
    return root


def rename_conflicts(cluster: Node, taken: set[str], spare: str | None = None) -> int:
    """Names of cluster tips that are taken get _dup1, _dup2, ...; the representative keeps its name."""
    count = 0
    for tip in cluster.tips():
        if tip.name in taken and tip.name != spare:
            k = 1
            while f"{tip.name}_dup{k}" in taken:
                k += 1
            tip.name, count = f"{tip.name}_dup{k}", count + 1
        taken.add(tip.name)
    return count


def graft(backbone: Node, tip: Node, cluster: Node, representative: str, mode: str = "keep") -> Node:
    """The backbone with a cluster's tree beside its representative's tip.

    A join node takes the tip's place with the tip and the cluster without its representative as children. Mode keep
    gives the join the tip's length and the tip 0; mode zero gives the join 0 and leaves the tip its length.
    """
    own = find_tip(cluster, representative)
    rest = prune(cluster, own) if own is not None else cluster
    if rest is None:
        return backbone
    rest.length = 0.0
    length = tip.length or 0.0
    twin = Node(tip.name, 0.0 if mode == "keep" else length)
    tip.name, tip.length, tip.children = None, length if mode == "keep" else 0.0, [twin, rest]
    return backbone


def graft_all(backbone: str, clusters: list[tuple[str, str, str | None]], mode: str = "keep", fuzzy: bool = False) -> tuple[str, list[tuple[str, str, str]]]:
    """Graft clusters (id, newick, representative) one after the other: the tree, and (id, representative, status)."""
    root, report = parse_newick(backbone), []
    for cluster_id, newick, representative in clusters:
        if not (newick or "").strip():
            report.append((cluster_id, representative or "", "skipped_empty"))
            continue
        cluster = parse_newick(newick)
        names = {t.name for t in root.tips()}
        representative = representative or infer_representative(cluster, names)
        tip = find_tip(root, representative, fuzzy) if representative else None
        if tip is None:
            report.append((cluster_id, representative or "", "failed_no_backbone_tip"))
            continue
        if (own := find_tip(cluster, representative, fuzzy)) is None:
            report.append((cluster_id, representative, "failed_no_cluster_tip"))
            continue
        rename_conflicts(cluster, names - {own.name}, own.name)
        root = graft(root, tip, cluster, own.name, mode)
        report.append((cluster_id, representative, "grafted"))
    return write_newick(root), report


def _grafted(backbones: DataFrame, clusters: DataFrame, mode: str, fuzzy: bool, out, schema: str) -> DataFrame:
    """out(tree_id, newick, report rows) of every backbone with its clusters, in order of cluster_id."""
    ship(backbones.sparkSession)

    def run(key, tree, parts):
        if not len(tree):
            return out(key[0], None, [(c, None if pd.isna(r) else r, "failed_no_backbone") for c, r in parts.sort_values("cluster_id")[["cluster_id", "representative"]].itertuples(index=False)])
        rows = [(c, n, None if pd.isna(r) else r) for c, n, r in parts.sort_values("cluster_id")[["cluster_id", "newick", "representative"]].itertuples(index=False)]
        return out(key[0], *graft_all(tree["newick"].iloc[0], rows, mode, fuzzy))

    return backbones.groupBy("tree_id").cogroup(clusters.groupBy("tree_id")).applyInPandas(run, schema)


def graft_trees(backbones: DataFrame, clusters: DataFrame, mode: str = "keep", fuzzy: bool = False) -> DataFrame:
    """(tree_id, newick, n_tips, n_grafted, n_failed): every backbone with its clusters, in order of cluster_id.

    backbones: tree_id, newick; clusters: tree_id, cluster_id, newick, representative.
    """

    def out(tree_id, newick, report):
        if newick is None:
            return pd.DataFrame(columns=["tree_id", "newick", "n_tips", "n_grafted", "n_failed"])
        good = sum(s == "grafted" for *_, s in report)
        return pd.DataFrame({"tree_id": [tree_id], "newick": [newick], "n_tips": [len(parse_newick(newick).tips())], "n_grafted": [good], "n_failed": [len(report) - good]})

    return _grafted(backbones, clusters, mode, fuzzy, out, "tree_id string, newick string, n_tips bigint, n_grafted bigint, n_failed bigint")


def graft_report(backbones: DataFrame, clusters: DataFrame, mode: str = "keep", fuzzy: bool = False) -> DataFrame:
    """(tree_id, cluster_id, representative, status): what became of every cluster; frames as for graft_trees."""

    def out(tree_id, newick, report):
        return pd.DataFrame({"tree_id": [tree_id] * len(report), "cluster_id": [c for c, _, _ in report], "representative": [r or "" for _, r, _ in report], "status": [s for *_, s in report]})

    return _grafted(backbones, clusters, mode, fuzzy, out, "tree_id string, cluster_id string, representative string, status string")
