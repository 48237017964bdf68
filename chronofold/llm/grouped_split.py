"""Splits that keep related records together: connected components, then closest split totals."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.skew import TASK_ROWS, distributed_rank, salted_join
from chronofold.session import drop_materialized, materialize

#: Sums that a subset sum tells apart; larger goals are scaled to it (16 MB of bits, and of 8-byte numbers for balanced_subset() an eighth as many sums).
SUMS = 1 << 26


def components(edges: DataFrame, *, floor: int = TASK_ROWS, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): the least node reachable.

    Rounds of hooking (every root takes the least neighbouring root as parent) and shortcutting
    (parents are replaced by their parents until trees are flat); then edges are rewritten to
    roots, loops and repeats dropped. Each round is written to the shared folder, in place of the one before. Null ends are no edge.
    """
    live = materialize(edges.where(F.col("u").isNotNull() & F.col("v").isNotNull()).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    parent = live.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("parent", F.col("node"))
    n_nodes = None
    for _ in range(max_rounds):
        rest = live.where("u != v")
        n_live = rest.count()
        if not n_live:
            return parent.select("node", F.col("parent").alias("component"))
        n_nodes = n_nodes or parent.count()
        hook = _shortcut(rest.groupBy("u").agg(F.min("v").alias("parent")).withColumnRenamed("u", "node"), floor)
        moved = rest
        for end in ("u", "v"):
            moved = _to_root(moved, end, hook, n_live, floor)
        old = live, parent, hook
        live = materialize(moved.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        parent = materialize(_to_root(parent, "parent", hook, n_nodes, floor))
        drop_materialized(*old)
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")


def _to_root(df: DataFrame, col: str, hook: DataFrame, rows: int, floor: int) -> DataFrame:
    """``df`` with the root that ``hook`` gives for ``col``, or ``col`` itself if it is a root."""
    found = salted_join(df, hook.select(F.col("node").alias(col), F.col("parent").alias("__root")), [col], "left", floor=floor, left_rows=rows)
    return found.withColumn(col, F.coalesce("__root", col)).drop("__root")


def _shortcut(hook: DataFrame, floor: int) -> DataFrame:
    """Parents of parents, until no parent has one."""
    flat = materialize(hook)
    rows = flat.count()
    while not flat.join(flat.select(F.col("node").alias("parent")), "parent", "left_semi").isEmpty():
        old = flat
        flat = materialize(_to_root(flat, "parent", flat, rows, floor))
        drop_materialized(old)
    return flat


def nodes_of(records: DataFrame, keys: Sequence[str], row_id: str) -> tuple[list[Column], Column]:
    """A node for the value of each key, never equal to a node of another key, null for null; and one for the record itself.

    If keys and ``row_id`` are whole numbers of at most 32 bits, nodes are 64-bit numbers (the key's place above the value), which is exact; else text, the
    value behind its hash, so that the order of nodes is unrelated to the values'.
    """
    kinds, names = dict(records.dtypes), [*keys, row_id]
    if all(kinds[k] in ("tinyint", "smallint", "int") for k in names):
        nodes = [F.col(k).cast("long") + F.lit((i + 1) << 33).cast("long") for i, k in enumerate(names)]
    else:
        nodes = []
        for i, k in enumerate(names):
            text = F.col(k).cast("string")
            nodes.append(F.when(text.isNotNull(), F.concat(F.lpad(F.hex(F.xxhash64(F.lit(i), text)), 16, "0"), F.lit(f":{i}:"), text)))
    return nodes[:-1], nodes[-1]


def related(records: DataFrame, keys: Sequence[str], row_id: str, *, floor: int = TASK_ROWS) -> DataFrame:
    """``records`` with ``component``: equal for records that share a value of any of ``keys``, directly or through others.

    Nodes are the keys' values. A record's first key is its centre; every other value is hooked to its least centre in one aggregate, so values with a single centre are leaves that
    never enter a round, and one with several only links these: a group of any size gives as many links as it
    has centres, never its pairs. The links are settled by components(). A record without any key is its own component, named after its ``row_id``.
    """
    nodes, own = nodes_of(records, keys, row_id)
    centre = F.coalesce(*nodes)
    named = records.withColumn("__node", centre)
    if len(keys) > 1:
        # A record's first value needs no hook: it is the centre, or the centre's place is taken by the next value, which is listed.
        ends = records.select(centre.alias("u"), F.explode(F.array_compact(F.array(*nodes[1:]))).alias("v"))
        hub = materialize(ends.groupBy("v").agg(F.min("u").alias("lo"), F.max("u").alias("hi")).where("lo < hi").select("v", "lo"))
        if hub.isEmpty():
            drop_materialized(hub)
        else:
            links = salted_join(ends, hub, ["v"], floor=floor).select("u", F.col("lo").alias("v"))
            found = components(links, floor=floor).withColumnRenamed("node", "__node")
            named = salted_join(named.drop("component"), found, ["__node"], "left", floor=floor).withColumn("__node", F.coalesce("component", "__node"))
    return named.withColumn("component", F.coalesce("__node", own)).drop("__node")


def torn(members: DataFrame, assignment: DataFrame, row_id: str, split: str, group: str) -> DataFrame:
    """Values of ``group`` that ``assignment`` tears apart: found as components with more than one split, then each checked to have more than one itself.

    ``members`` is the result of related(). Split names are compared without case and outer blanks; null and rows without an id are no split.
    """
    name = F.lower(F.trim(split))
    given = assignment.where(F.col(row_id).isNotNull() & F.col(split).isNotNull()).groupBy(row_id).agg(F.min(name).alias("lo"), F.max(name).alias("hi"))
    placed = members.select("component", row_id, group).join(given, row_id)
    ends = [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    # By component and group first, as far as a task has them together: the components are then read off the same states.
    states = placed.groupBy("component", group).agg(*ends)
    apart = states.groupBy("component").agg(*ends).where("lo != hi").select("component")
    return states.join(apart, "component", "left_semi").where(F.col(group).isNotNull() & (F.col("lo") != F.col("hi"))).select(group).distinct()


def closest_subset(available: dict[int, int], target: int, sums: int = SUMS) -> dict[int, int]:
    """How many of each size to take so that their sum is as close to ``target`` as any choice gets (the lower sum of two equally close).

    ``available`` maps sizes to multiplicities. Reachable sums are the bits of one integer; a multiplicity
    is added in doublings, and the bits kept before each size let the choice be read back. A target above ``sums`` is first approached by the sizes of
    at least target / ``sums``, counted in such units, then by all that still fit, largest first; the
    choice then need not be the closest, but misses by at most half a unit for every large component taken, less what the small ones make up for.
    """
    if target <= 0 or not available:
        return {}
    unit = -(-target // sums)
    if unit > 1:
        coarse: dict[int, list[int]] = {}
        for size in sorted(available, reverse=True):
            if size >= unit:
                coarse.setdefault(round(size / unit), []).append(size)
        chosen = closest_subset({u: sum(available[x] for x in of) for u, of in coarse.items()}, target // unit, sums)
        taken: dict[int, int] = {}
        for u, k in chosen.items():
            for size in coarse[u]:
                use = min(k, available[size])
                if use:
                    taken[size], k = use, k - use
        return _topped_up(taken, available, target, lambda c: c)
    limit = 2 * target + 1
    mask, reach, kept = (1 << limit) - 1, 1, []
    for size, many in sorted(available.items(), reverse=True):
        kept.append((size, many, reach))
        many = min(many, limit // size)
        step = 1
        while many > 0:
            take = min(step, many)
            reach |= (reach << (size * take)) & mask
            many, step = many - take, step * 2
    low = reach & ((1 << (target + 1)) - 1)
    best = low.bit_length() - 1
    high = reach >> (target + 1)
    if high and (up := (high & -high).bit_length() - 1 + target + 1) - target < target - best:
        best = up
    taken = {}
    for size, many, before in reversed(kept):
        k = next(k for k in range(min(many, best // size) + 1) if before >> (best - k * size) & 1)
        if k:
            taken[size] = k
        best -= k * size
    return taken


def _topped_up(taken: dict, available: dict, target: int, weight) -> dict:
    """``taken``, brought near to ``target`` from below: what is too much is given back, then what fits is added, the heaviest first."""
    left = target - sum(weight(c) * k for c, k in taken.items())
    for c in sorted(taken, key=weight):
        if left < 0:
            back = min(taken[c], -(left // weight(c)))
            taken[c] -= back
            left += back * weight(c)
    for c in sorted(available, key=weight, reverse=True):
        more = min(available[c] - taken.get(c, 0), left // weight(c)) if weight(c) else 0
        if more > 0:
            taken[c] = taken.get(c, 0) + more
            left -= more * weight(c)
    return {c: k for c, k in taken.items() if k}


def balanced_subset(available: dict[tuple[int, int], int], positives: int, least: int, most: int, scale: tuple[int, int], sums: int = SUMS >> 3) -> dict[tuple[int, int], int]:
    """How many of each class (rows, positives > 0) to take so that their positives come close to ``positives`` and their rows
    between ``least`` and ``most``.

    Both distances count by the split's own goals, ``scale`` (rows, positives), and their sum is the least that any choice has
    outside of one side of the rows: for each sum of positives the choices of fewest and of most rows are exact. Among equals
    the one that follows the classes' own ratio of rows to positives is taken, if found, so that no size is preferred. More positives than ``sums`` are
    counted in units of positives / ``sums`` first, as in closest_subset().
    """
    if positives <= 0 or not available:
        return {}
    unit = -(-positives // sums)
    if unit > 1:
        coarse: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for c in sorted(available, reverse=True):
            if c[1] >= unit:
                coarse.setdefault((c[0], round(c[1] / unit)), []).append(c)
        taken: dict[tuple[int, int], int] = {}
        for u, k in balanced_subset({u: sum(available[c] for c in of) for u, of in coarse.items()}, positives // unit, least, most, (scale[0], max(1, scale[1] // unit)), sums).items():
            for c in coarse[u]:
                use = min(k, available[c])
                if use:
                    taken[c], k = use, k - use
        return _topped_up(taken, available, positives, lambda c: c[1])
    limit = 2 * positives + 1
    bundles = []
    for (n, p), many in sorted(available.items(), reverse=True):
        many, step = min(many, (limit - 1) // p), 1
        while many > 0:
            bundles.append(((n, p), min(step, many)))
            many, step = many - step, step * 2
    sums = np.arange(limit)
    ratio = sum(n * m for (n, _), m in available.items()) / sum(p * m for (_, p), m in available.items())
    best = None
    for line in (sums * ratio, np.zeros(limit), np.full(limit, 2.0**62)):
        held, taken = np.where(sums == 0, 0, -1), []
        for (n, p), k in bundles:
            more = np.full(limit, -1)
            more[p * k :] = np.where(held[: limit - p * k] >= 0, held[: limit - p * k] + n * k, -1)
            closer = (more >= 0) & ((held < 0) | (np.abs(more - line) < np.abs(held - line)))
            held = np.where(closer, more, held)
            taken.append(np.packbits(closer))
        cost = np.abs(sums - positives) / scale[1] + np.maximum(0, np.maximum(held - most, least - held)) / scale[0]
        cost[held < 0] = np.inf
        q = int(np.argmin(cost))
        if best is None or cost[q] < best[0] - 1e-12:
            best = cost[q], q, taken
    _, q, taken = best
    out: dict[tuple[int, int], int] = {}
    for (c, k), bits in zip(reversed(bundles), reversed(taken), strict=True):
        if bits[q >> 3] >> (7 - (q & 7)) & 1:
            out[c] = out.get(c, 0) + k
            q -= c[1] * k
    return out


def quotas(classes: dict[tuple[int, int], int], shares: Sequence[float], slack: int = 4) -> dict[tuple[int, int], list[int]]:
    """Per class (rows, positives) -> how many components each split but the last one (the first of ``shares``) gets.

    ``classes`` holds how many components there are of each class. Components of more rows than the smallest split is to have (and
    a 64th of all) are placed first, each where most rows are wanted. Then components with positives are chosen so that a split's
    positives and rows come closest to its share, then those without so that its rows do. Most of a class is shared out in proportion;
    only what is left, and ``slack`` more of each class, enters the subset sum, whose size is as much as the rest is large.
    """
    left, out = dict(classes), {c: [0] * len(shares) for c in classes}
    rows, positives = sum(n * m for (n, _), m in classes.items()), sum(p * m for (_, p), m in classes.items())
    wanted, wanted_positives = [round(x * rows) for x in shares], [round(x * positives) for x in shares]
    wanted[0], wanted_positives[0] = rows - sum(wanted[1:]), positives - sum(wanted_positives[1:])
    for c in sorted((c for c in classes if c[0] > max(min(wanted), rows / 64)), reverse=True):
        for _ in range(left[c]):
            s = max(range(len(shares)), key=lambda k: (wanted[k], wanted_positives[k], -k))
            out[c][s] += 1
            wanted[s] -= c[0]
            wanted_positives[s] -= c[1]
        left[c] = 0
    for s in range(1, len(shares)):
        scale = max(1, round(shares[s] * rows)), max(1, round(shares[s] * positives))
        room = wanted[s]
        for stratum in (True, False):
            mine = [c for c in classes if (c[1] > 0) == stratum and left[c]]
            weight = (lambda c: c[1]) if stratum else (lambda c: c[0])
            goal = wanted_positives[s] if stratum else room
            total = sum(weight(c) * left[c] for c in mine)
            share = max(0.0, min(1.0, goal / total)) if total else 0.0
            for c in mine:
                base = max(0, int(share * left[c]) - slack)
                out[c][s] += base
                left[c] -= base
                goal -= base * weight(c)
                room -= base * c[0]
            if stratum:
                fill = sum(n * m for (n, p), m in left.items() if not p)
                chosen = balanced_subset({c: left[c] for c in mine if left[c]}, goal, room - fill, room, scale)
            else:
                pool = {c[0]: left[c] for c in mine if left[c]}
                sizes = closest_subset({w: min(m, max(0, goal) // w + 1) for w, m in pool.items()}, goal)
                chosen = {(w, 0): k for w, k in sizes.items()}
            for c, take in chosen.items():
                out[c][s] += take
                left[c] -= take
                room -= take * c[0]
    for c in classes:
        out[c][0] = 0
    return out


def _digits(count: str, digits: int) -> Column:
    """The count with all but its first binary digits 0."""
    return F.expr(f"CASE WHEN {count} < {1 << digits} THEN {count} ELSE shiftleft(shiftright({count}, cast(floor(log2({count})) AS int) - {digits - 1}), cast(floor(log2({count})) AS int) - {digits - 1}) END")


def grouped_split(records: DataFrame, keys: Sequence[str], row_id: str, target: str, shares: dict[str, float], *, seed: str = "42", floor: int = TASK_ROWS) -> DataFrame:
    """``records`` with ``component`` and ``split``: no component is torn, rows and positive targets come as close to ``shares`` as whole components allow.

    The first of ``shares`` takes what the others leave. Which components of a class go where is decided by a hash of their name and ``seed``, so the split
    doesn't depend on the order of rows. Only the histogram of components by (rows, positives) comes to the driver; counts above 2**8 rows or 2**5 positives share
    a class if they agree in their first 8 or 5 binary digits, which bounds the classes at any number of rows (about 1.3 million; a class counts by its mean). A null or NaN target isn't positive.
    """
    grouped = materialize(related(records, keys, row_id, floor=floor))
    positive = F.coalesce((F.nanvl(F.col(target).cast("double"), F.lit(0.0)) > 0).cast("int"), F.lit(0))
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("__n"), F.sum(positive).alias("__p"))
    sizes = materialize(sizes.select("component", "__n", "__p", _digits("__n", 8).alias("__rows"), _digits("__p", 5).alias("__pos")))
    found = sizes.groupBy("__rows", "__pos").agg(F.count(F.lit(1)).alias("m"), F.sum("__n").alias("n"), F.sum("__p").alias("p")).collect()
    means = {(r["__rows"], r["__pos"]): (round(r["n"] / r["m"]), round(r["p"] / r["m"])) for r in found}
    planned = quotas({means[(r["__rows"], r["__pos"])]: r["m"] for r in found}, list(shares.values()))
    plan = {c: planned[mean] for c, mean in means.items()}
    names = list(shares)
    table = records.sparkSession.createDataFrame([(n, p, q[1:]) for (n, p), q in plan.items()], "__rows long, __pos long, __q array<long>")
    ranked = distributed_rank(sizes, ["__rows", "__pos"], F.md5(F.concat(F.col("component").cast("string"), F.lit(f"|{seed}"))), ["component"], "__rank").join(F.broadcast(table), ["__rows", "__pos"])
    split, upto = F.lit(names[0]), F.lit(0)
    bounds = []
    for k, name in enumerate(names[1:]):
        upto = upto + F.col("__q")[k]
        bounds.append((upto, name))
    choice = None
    for upto, name in bounds:
        choice = F.when(F.col("__rank") <= upto, name) if choice is None else choice.when(F.col("__rank") <= upto, name)
    placed = ranked.select("component", (choice.otherwise(names[0]) if choice is not None else split).alias("split"))
    return salted_join(grouped.drop("split"), placed, ["component"], floor=floor)
