"""Distance joins against brute force, with a crowded cell."""

import math
import random

import pytest

from cif_lake.operators import geometry


@pytest.fixture(scope="module")
def atoms(spark):
    rng = random.Random(3)
    rows = []
    for n in range(260):
        crowd = n % 3 == 0  # a third of the atoms share one place
        xyz = (1.0, 1.0, 1.0) if crowd else tuple(rng.uniform(-9, 9) for _ in range(3))
        comp = ["LIG", "ALA", "GLY", "HOH"][n % 4]
        rows.append((f"f{n % 2}", str(n % 60), ["CA", "N", "O"][n % 3], comp, "AB"[n % 5 % 2], *xyz))
    return spark.createDataFrame(
        rows,
        "filename string, auth_seq_id string, label_atom_id string, label_comp_id string, auth_asym_id string, "
        "Cartn_x double, Cartn_y double, Cartn_z double",
    ).cache()


def brute(rows, left, right, cutoff):
    for a in filter(left, rows):
        for b in filter(right, rows):
            d = math.dist(a[5:], b[5:])
            if a["filename"] == b["filename"] and d <= cutoff:
                yield a, b, d


@pytest.mark.parametrize("salts", [1, 3])
def test_interface_pairs(atoms, salts):
    rows = atoms.collect()
    side = lambda c: lambda r: r["auth_asym_id"] == c and r["label_comp_id"] != "HOH"
    want = {}
    for a, b, d in brute(rows, side("A"), side("B"), 4.0):
        key = (a["filename"], a["label_comp_id"] + a["auth_seq_id"], b["label_comp_id"] + b["auth_seq_id"])
        n, least = want.get(key, (0, 99))
        want[key] = (n + 1, min(least, d))
    got = geometry.interface_pairs(atoms, "A", "B", 4.0, salts=salts).collect()
    assert {(r["filename"], r["res_a"], r["res_b"]): r["atom_pairs"] for r in got} == {k: v[0] for k, v in want.items()}
    assert all(abs(r["min_dist"] - want[r["filename"], r["res_a"], r["res_b"]][1]) < 0.006 for r in got)


def test_pocket_and_shell(atoms):
    rows = atoms.collect()
    lig = lambda r: r["label_comp_id"] == "LIG" and r["auth_asym_id"] == "A"
    water = lambda r: r["label_comp_id"] == "HOH" and r["auth_asym_id"] == "A"
    around = lambda r: r["auth_asym_id"] == "A" and r["label_comp_id"] not in ("LIG", "HOH")
    contacts = {}
    for _, w, _ in brute(rows, lig, water, 3.5):
        contacts[w["filename"], w["auth_seq_id"]] = contacts.get((w["filename"], w["auth_seq_id"]), 0) + 1
    shell = geometry.hydration_shell(atoms, "LIG", "A").collect()
    assert {(r["filename"], r["water_seq"]): r["ligand_atom_contacts"] for r in shell} == contacts
    names, least = {}, {}
    for _, a, d in brute(rows, lig, around, 4.0):
        names.setdefault((a["filename"], a["auth_seq_id"], a["label_comp_id"]), set()).add(a["label_atom_id"])
        key = (a["filename"], a["auth_seq_id"])
        least[key] = min(least.get(key, 99), d)
    pocket = geometry.pocket_residues(atoms, "LIG", "A").collect()
    assert {(r["filename"], r["seq"], r["res"]): r["atoms_in_contact"] for r in pocket} == {k: len(v) for k, v in names.items()}
    closest = geometry.pocket_closest(atoms, "LIG", "A").collect()
    assert {(r["filename"], r["seq"]) for r in closest} == set(least)
    assert all(abs(r["dist"] - least[r["filename"], r["seq"]]) < 0.006 for r in closest)


def test_no_nested_loop(atoms):
    plan = geometry.interface_pairs(atoms, "A", "B", 4.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
