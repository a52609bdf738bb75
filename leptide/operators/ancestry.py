"""Particle ancestry: who descends from a hadron, a boson, the hard process.

Instead of walking up from every candidate, flags spread down from the source
particles: a particle is flagged once, so the work is linear in the number of
mother links however many candidates share an ancestor, and cycles end by
themselves. Links never leave their event: after one shuffle by event a task
follows them to the end over arrays, many events at a time, however many
generations there are. Events of more links than a task should hold go
generation by generation, a join each, cut from the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import Sql, num
from ..session import cut

KEY = ("event_id", "idx")


# fixed code ranges of the particle numbering scheme
def is_hadron(pid: Sql) -> Sql:
    a = f"abs({pid})"
    return f"({a} not in (230, 231) and (({a} >= 100 and {a} < 1000000) or {a} >= 1000000000))"


def is_parton(pid: Sql) -> Sql:
    return f"(abs({pid}) <= 6 or abs({pid}) = 21)"


def is_boson(pid: Sql) -> Sql:
    return f"(abs({pid}) in (23, 24, 230, 231))"


def mother_links(particles: DataFrame) -> DataFrame:
    """(event_id, child, mother) with attributes of both ends.

    Reads event_id, idx, pid, status, m1, m2, mass. Both mother fields count,
    once each; links to particles that are not in the event are dropped by the
    join.
    """
    links = particles.selectExpr(
        "event_id", "idx as child", "pid as child_pid", "status as child_status",
        "explode(array_distinct(array(m1, m2))) as mother",
    ).where("mother >= 0")
    mothers = particles.selectExpr(
        "event_id", "idx as mother", "pid as mother_pid", "status as mother_status", "mass as mother_mass"
    )
    return links.join(mothers, ["event_id", "mother"])


#: Links of an event that one task follows; about 100 MB of arrays.
MOST_LINKS = 1 << 21


def spread_down(links: DataFrame, seeds: DataFrame, keys: Sequence[str] = KEY, *, most_links: int = MOST_LINKS) -> DataFrame:
    """Least fixpoint: seeds plus every child of a flagged mother along `links`.

    `links` has (keys[:-1]..., mother, child), `seeds` has `keys`; null keys
    reach nothing. Both meet in one shuffle by event. Events beyond
    `most_links` links, counted map-side first, are followed by joins.
    """
    group = list(keys[:-1])
    links, seeds = links.select(*group, "mother", "child").dropna(), seeds.select(*keys).dropna().distinct()
    long = cut(links.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") > most_links).select(*group))
    if long.isEmpty():
        return _followed(links, seeds, keys)
    usual = _followed(links.join(long, group, "left_anti"), seeds.join(long, group, "left_anti"), keys)
    return usual.unionByName(_rounds(links.join(long, group, "left_semi"), seeds.join(long, group, "left_semi"), keys))


def _followed(links: DataFrame, seeds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flagged particles, whole events at a time inside a task."""
    group, last = list(keys[:-1]), keys[-1]
    both = links.selectExpr(*group, "bigint(mother) as mother", "bigint(child) as child").unionByName(
        seeds.selectExpr(*group, "cast(null as bigint) as mother", f"bigint({last}) as child")
    )
    kinds = dict(seeds.dtypes)

    def flagged(rows: pa.Table) -> pa.RecordBatch:
        """Complete events: number their particles, then flag children of new ones until there are none."""
        event = np.zeros(rows.num_rows, np.int64)
        for k in group:
            event = np.unique(event * (rows.num_rows + 1) + rows.column(k).combine_chunks().dictionary_encode().indices.to_numpy(), return_inverse=True)[1]
        child, mother = rows.column("child").to_numpy(), rows.column("mother")
        is_link = mother.is_valid().to_numpy()
        value = np.where(is_link, pc.fill_null(mother, 0).to_numpy(), child)
        names, code = np.unique(np.concatenate([child, value]), return_inverse=True)
        node, at = np.unique(np.tile(event, 2) * len(names) + code, return_inverse=True)
        to, by = at[: len(child)], at[len(child) :]
        order = np.argsort(by[is_link], kind="stable")
        to_sorted, by_sorted = to[is_link][order], by[is_link][order]
        first = np.searchsorted(by_sorted, np.arange(len(node) + 1))
        seen = np.zeros(len(node), bool)
        new = np.unique(to[~is_link])
        while len(new):
            seen[new] = True
            n = first[new + 1] - first[new]
            ends = np.cumsum(n)
            reach = to_sorted[np.repeat(first[new] - ends + n, n) + np.arange(int(ends[-1]))]
            new = np.unique(reach[~seen[reach]])
        hit = np.flatnonzero(seen)
        # one row of each flagged particle
        row = np.zeros(len(node), np.int64)
        row[at] = np.tile(np.arange(rows.num_rows), 2)
        out = {k: rows.column(k).take(pa.array(row[hit])).combine_chunks() for k in group}
        return pa.RecordBatch.from_pydict(out | {last: pa.array(names[node[hit] % len(names)])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            same = np.ones(batch.num_rows - 1, bool)
            for k in group:
                x = batch.column(k)
                same &= pc.equal(x.slice(1), x.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(~same) + 1
            if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in group):
                yield flagged(pa.Table.from_batches(held))
                held = []
            if len(starts):
                held.append(batch.slice(0, int(starts[-1])))
                yield flagged(pa.Table.from_batches(held))
                held = []
                batch = batch.slice(int(starts[-1]))
            held.append(batch)
        if held:
            yield flagged(pa.Table.from_batches(held))

    found = both.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in group), f"{last} bigint"]))
    return found.selectExpr(*group, f"cast({last} as {kinds[last]}) as {last}")


def _rounds(links: DataFrame, seeds: DataFrame, keys: Sequence[str], max_rounds: int = 10_000) -> DataFrame:
    """The same generation by generation. Beyond max_rounds it raises, it drops nothing."""
    group = list(keys[:-1])
    links = cut(links)
    reached = frontier = cut(seeds)
    for _ in range(max_rounds):
        if frontier.isEmpty():
            return reached
        step = (
            links.join(frontier.withColumnRenamed(keys[-1], "mother"), [*group, "mother"])
            .select(*group, F.col("child").alias(keys[-1]))
            .distinct()
            .join(reached, list(keys), "left_anti")
        )
        frontier = cut(step)
        reached = reached.unionByName(frontier)
    raise RuntimeError("ancestry did not converge")


def hadron_descendants(links: DataFrame) -> DataFrame:
    """Particles with a hadron among their ancestors; ancestry ends at partons."""
    seeds = links.where(is_hadron("mother_pid")).selectExpr("event_id", "child as idx")
    passable = links.where(f"not {is_parton('mother_pid')}").select("event_id", "mother", "child")
    return spread_down(passable, seeds)


def boson_descendants(
    links: DataFrame, flavors: Sequence[int] = (11, 13), *, allow_tau: bool = False, min_photon_mass: float = 5.0
) -> DataFrame:
    """(event_id, flavor, idx): lepton lines of a flavour that reach a boson.

    Only copies of the same flavour are followed (taus too when allowed); a
    photon counts as a boson above the mass threshold.
    """
    lines = ", ".join(str(int(f)) for f in flavors)
    source = f"({is_boson('mother_pid')} or (abs(mother_pid) = 22 and mother_mass > {num(min_photon_mass)}))"
    own = lambda pid: f"(abs({pid}) = flavor{f' or abs({pid}) = 15' if allow_tau else ''})"
    by_flavor = links.selectExpr("*", f"explode(array({lines})) as flavor").where(own("child_pid"))
    seeds = by_flavor.where(source).selectExpr("event_id", "flavor", "child as idx")
    passable = by_flavor.where(own("mother_pid")).select("event_id", "flavor", "mother", "child")
    return spread_down(passable, seeds, ("event_id", "flavor", "idx"))


def hard_process_descendants(particles: DataFrame, links: DataFrame) -> DataFrame:
    """Leptons that are exact signed copies of one made by two hard gluons."""
    pairs = links.groupBy("event_id", "child").agg(
        F.count("*").alias("mothers"),
        F.expr("count_if(mother_pid = 21 and mother_status = 21) as gluons"),
    )
    seeds = (
        particles.where("status in (1, 23) and abs(pid) in (11, 13)")
        .select("event_id", F.col("idx").alias("child"))
        .join(pairs.where("mothers = 2 and gluons = 2"), ["event_id", "child"], "left_semi")
        .withColumnRenamed("child", "idx")
    )
    copies = links.where("mother_pid = child_pid").select("event_id", "mother", "child")
    return spread_down(copies, seeds)


def origin_flags(
    particles: DataFrame, *, allow_tau: bool = False, min_photon_mass: float = 5.0
) -> DataFrame:
    """Charged-lepton candidates with the three origin flags."""
    links = cut(mother_links(particles))
    flag = lambda df, name: df.withColumn(name, F.lit(True))
    leptons = particles.where("abs(pid) in (11, 13)").withColumn("flavor", F.abs("pid"))
    out = (
        leptons.join(flag(hadron_descendants(links), "_h"), list(KEY), "left")
        .join(
            flag(boson_descendants(links, allow_tau=allow_tau, min_photon_mass=min_photon_mass), "_b"),
            ["event_id", "flavor", "idx"], "left",
        )
        .join(flag(hard_process_descendants(particles, links), "_d"), list(KEY), "left")
    )
    return out.selectExpr(
        *[c for c in leptons.columns if c != "flavor"],
        "coalesce(_h, false) as has_hadron_ancestor",
        "coalesce(_b, false) as has_boson_ancestor",
        "coalesce(_d, false) as has_hard_process_ancestor",
    )


def eligible(*, no_hadron: bool = True, boson: bool = False, hard_process: bool = False) -> Sql:
    """Origin rule over the three flags."""
    parts = ["true"]
    if no_hadron:
        parts.append("not has_hadron_ancestor")
    if boson:
        parts.append("has_boson_ancestor")
    if hard_process:
        parts.append("has_hard_process_ancestor")
    return "(" + " and ".join(parts) + ")"
