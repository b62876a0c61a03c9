"""Neighbour searches and transforms in three dimensions.

A distance join is an equi-join on grid cells of the size of the cutoff: one side goes to its own cell, the other to the
27 cells around it, and the exact distance decides. Neither a cross join nor a nested loop is planned. A cell that holds very
many points (overlaid models, for instance) is spread by a salt: the probe side takes one of ``salts`` values per row, the build
side is repeated for each of them, so the pairs of one cell are found by many tasks; AQE splits what is still skewed.

Equal points of one residue or ligand atom are joined once and weighted, so stacked copies do not multiply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("filename",)
AXES = ("Cartn_x", "Cartn_y", "Cartn_z")


def points3d(atoms: DataFrame) -> DataFrame:
    """Atoms with coordinates, as ``point(x, y, z)``."""
    x, y, z = (F.col(a) for a in AXES)
    return atoms.filter(x.isNotNull()).withColumn("point", F.struct(x.alias("x"), y.alias("y"), z.alias("z")))


def distance(a: str, b: str) -> Column:
    """Distance of two structs ``(x, y, z)``."""
    d = [F.col(f"{a}.{i}") - F.col(f"{b}.{i}") for i in "xyz"]
    return F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])


def _cells(point: str, cutoff: float) -> list[Column]:
    return [F.floor(F.col(f"{point}.{i}") / F.lit(float(cutoff))) for i in "xyz"]


def within(
    build: DataFrame,
    probe: DataFrame,
    cutoff: float,
    keys: Sequence[str] = KEYS,
    salts: int = 1,
) -> DataFrame:
    """Pairs of points at most ``cutoff`` apart, in the same file.

    Both frames have ``keys`` and a point struct: ``build`` calls it ``a``, ``probe`` calls it ``b``; other column names must
    differ. ``build`` should be the smaller one: it is repeated 27 times. Gives all columns and ``d``.
    """
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    shifted = lambda c: F.transform(near, lambda i: c + i)
    cx, cy, cz = _cells("a", cutoff)
    out = build.withColumn("cx", F.explode(shifted(cx))).withColumn("cy", F.explode(shifted(cy)))
    out = out.withColumn("cz", F.explode(shifted(cz)))
    px, py, pz = _cells("b", cutoff)
    inn = probe.withColumn("cx", px).withColumn("cy", py).withColumn("cz", pz)
    on = [*keys, "cx", "cy", "cz"]
    if salts > 1:
        out = out.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        inn = inn.withColumn("salt", F.pmod(F.xxhash64(*[F.col(c) for c in probe.columns]), F.lit(salts)).cast("int"))
        on.append("salt")
    return inn.join(out, on).withColumn("d", distance("a", "b")).filter(F.col("d") <= cutoff).drop(*on[len(keys):])


def _side(points: DataFrame, keys: Sequence[str], point: str, weight: str, **columns: str) -> DataFrame:
    """Distinct points with the named columns and the number of atoms behind each."""
    named = points.select(*keys, F.col("point").alias(point), *[F.col(c).alias(n) for n, c in columns.items()])
    return named.groupBy(*named.columns).agg(F.count("*").alias(weight))


def _ligand(points: DataFrame, ligand: str, chain: str) -> DataFrame:
    return points.filter((F.col("label_comp_id") == ligand) & (F.col("auth_asym_id") == chain))


def _around(points: DataFrame, ligand: str, chain: str) -> DataFrame:
    return points.filter((F.col("auth_asym_id") == chain) & ~F.col("label_comp_id").isin(ligand, "HOH"))


def pocket_residues(
    atoms: DataFrame, ligand: str, chain: str, cutoff: float = 4.0, keys: Sequence[str] = KEYS, salts: int = 1
) -> DataFrame:
    """Residues with an atom near the ligand: atoms in contact and the smallest distance."""
    p = points3d(atoms)
    pairs = within(
        _side(_ligand(p, ligand, chain), keys, "a", "na"),
        _side(_around(p, ligand, chain), keys, "b", "nb", seq="auth_seq_id", res="label_comp_id", atom="label_atom_id"),
        cutoff, keys, salts,
    )
    # Two steps instead of count(DISTINCT): pairs shrink to atoms before the shuffle.
    per_atom = pairs.groupBy(*keys, "seq", "res", "atom").agg(F.min("d").alias("d"))
    return per_atom.groupBy(*keys, "seq", "res").agg(
        F.count("atom").alias("atoms_in_contact"), F.round(F.min("d"), 2).alias("min_dist")
    )


def pocket_closest(
    atoms: DataFrame, ligand: str, chain: str, cutoff: float = 4.0, keys: Sequence[str] = KEYS, salts: int = 1
) -> DataFrame:
    """Closest ligand atom of each residue; ties go to the first atom names."""
    p = points3d(atoms)
    pairs = within(
        _side(_ligand(p, ligand, chain), keys, "a", "na", ligand_atom="label_atom_id"),
        _side(_around(p, ligand, chain), keys, "b", "nb", seq="auth_seq_id", res="label_comp_id"),
        cutoff, keys, salts,
    )
    # min_by is the row_number() = 1 of the smallest distance, with a partial aggregate.
    best = F.min_by(F.struct("res", "ligand_atom", "d"), F.struct("d", "res", "ligand_atom"))
    return pairs.groupBy(*keys, "seq").agg(best.alias("m")).select(
        *keys, "seq", "m.res", "m.ligand_atom", F.round("m.d", 2).alias("dist")
    )


def interface_pairs(
    atoms: DataFrame,
    chain_a: str,
    chain_b: str,
    cutoff: float = 4.0,
    skip: Sequence[str] = ("HOH",),
    keys: Sequence[str] = KEYS,
    salts: int = 1,
) -> DataFrame:
    """Residue pairs across two chains: number of atom pairs and the smallest distance."""
    p = points3d(atoms).filter(~F.col("label_comp_id").isin(*skip))
    name = F.concat("label_comp_id", "auth_seq_id")

    def side(chain: str, point: str, res: str, n: str) -> DataFrame:
        return _side(p.filter(F.col("auth_asym_id") == chain).withColumn("res", name), keys, point, n, **{res: "res"})

    pairs = within(side(chain_a, "a", "res_a", "na"), side(chain_b, "b", "res_b", "nb"), cutoff, keys, salts)
    return pairs.groupBy(*keys, "res_a", "res_b").agg(
        F.sum(F.col("na") * F.col("nb")).alias("atom_pairs"), F.round(F.min("d"), 2).alias("min_dist")
    )


def hydration_shell(
    atoms: DataFrame, ligand: str, chain: str, cutoff: float = 3.5, keys: Sequence[str] = KEYS, salts: int = 1
) -> DataFrame:
    """Waters near the ligand: contacts with ligand atoms and the smallest distance."""
    p = points3d(atoms)
    water = p.filter((F.col("label_comp_id") == "HOH") & (F.col("auth_asym_id") == chain))
    pairs = within(
        _side(_ligand(p, ligand, chain), keys, "a", "na"), _side(water, keys, "b", "nb", water_seq="auth_seq_id"), cutoff, keys, salts
    )
    return pairs.groupBy(*keys, "water_seq").agg(
        F.sum(F.col("na") * F.col("nb")).alias("ligand_atom_contacts"), F.round(F.min("d"), 2).alias("min_dist")
    )


def bounding_box(atoms: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    p = points3d(atoms)
    extent = lambda i: F.round(F.max(f"point.{i}") - F.min(f"point.{i}"), 1)
    return p.groupBy(*keys).agg(extent("x").alias("width_x"), extent("y").alias("width_y"), extent("z").alias("depth_z"))


# Fixed value: quarter turn about the z axis, row by row.
QUARTER_TURN_Z = ((0, -1, 0), (1, 0, 0), (0, 0, 1))


def rigid_transform(
    atoms: DataFrame, matrix: Sequence[Sequence[float]] = QUARTER_TURN_Z, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Move the centre of the atoms of each file to the origin, then apply the 3x3 matrix: adds ``after(x, y, z)``."""
    p = points3d(atoms)
    centre = p.groupBy(*keys).agg(*[F.avg(f"point.{i}").alias(f"c{i}") for i in "xyz"])
    joined = p.join(centre, list(keys)) if keys else p.join(F.broadcast(centre))  # without keys: one row
    moved = [F.col(f"point.{i}") - F.col(f"c{i}") for i in "xyz"]

    def turned(row: Sequence[float]) -> Column:
        terms = [m if k == 1 else -m if k == -1 else m * F.lit(float(k)) for k, m in zip(row, moved) if k != 0]
        return sum(terms[1:], terms[0]) if terms else F.lit(0.0)

    after = F.struct(*[turned(row).alias(i) for row, i in zip(matrix, "xyz")])
    return joined.withColumn("after", after).drop("cx", "cy", "cz")


def ca_trace(atoms: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ordered planar trace of the alpha carbons of each chain: atom count, point count and text form.

    A chain of one file is one row of the result, as a trace is one line.
    """
    ca = points3d(atoms).filter((F.col("label_atom_id") == "CA") & ~F.col("label_comp_id").isin("HOH"))
    traced = ca.groupBy(*keys, "auth_asym_id").agg(
        F.count("*").alias("ca_atoms"),
        F.array_sort(F.collect_list(F.struct("auth_seq_id", F.col("point.x").alias("x"), F.col("point.y").alias("y")))).alias("t"),
    )
    text = F.array_join(F.transform("t", lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", ")
    return traced.select(
        *keys, "auth_asym_id", "ca_atoms", F.size("t").cast("bigint").alias("ca_trace_points"),
        F.concat(F.lit("LINESTRING ("), text, F.lit(")")).alias("trace"),
    )
