import json
import random

import pytest
from rows import table

from pairmill.config import PrepConfig
from pairmill.errors import JobFailed
from pairmill.operators import curate
from pairmill.operators.fingerprint import covers, fingerprint, merged, side_fingerprints
from pairmill.plans import prepare as plan
from pairmill.sources import files

PAIRS = "instruction string, response string"


def hashed(spark, names):
    return curate.with_content_hash(table(spark, [(n, "a") for n in names], PAIRS))


def only(frame):
    return tuple(frame.first())


def test_order_is_free_and_any_change_shows(spark):
    names = [f"q{i}" for i in range(200)]
    first = only(fingerprint(hashed(spark, names)))
    random.Random(1).shuffle(names)
    assert only(fingerprint(hashed(spark, names).repartition(9))) == first
    for changed in (names[1:], names + names[:1], ["other", *names[1:]], [*names[:-1], names[0]]):
        assert only(fingerprint(hashed(spark, changed))) != first
    assert first[0] == 200 and only(fingerprint(hashed(spark, names).limit(0))) == (0, 0, 0)


def test_parts_add_up(spark):
    whole = hashed(spark, [f"q{i}" for i in range(90)])
    train, held_out = curate.split_holdout(whole)
    sides = side_fingerprints({"deduped": whole, "train": train, "eval": held_out})
    found = {r[0]: tuple(r)[1:] for r in sides.collect()}
    assert covers(found, "deduped", ("train", "eval"))
    assert not covers(found, "deduped", ("train",))
    # A row that moved is counted once; one that is on both sides, or swapped, is noticed.
    doubled = side_fingerprints(
        {"deduped": whole, "train": train.unionByName(held_out.limit(1)), "eval": held_out})
    assert not covers({r[0]: tuple(r)[1:] for r in doubled.collect()}, "deduped", ("train", "eval"))
    parts = sides.where("side <> 'deduped'")
    assert only(merged(parts)) == found["deduped"]


def config(folder, run):
    return PrepConfig(f"{folder}/raw", f"{folder}/data", run, "base", max_len=300)


def test_manifest_tells_a_changed_version(spark, folder):
    version = plan.prepare(spark, config(folder, "one"))
    told = {r["side"]: r["rows"] for r in plan.read_fingerprints(spark, version).collect()}
    assert told == {"deduped": 8, "train": 6, "eval": 2, "kept": 6}
    assert all(r["intact"] for r in plan.check_version(spark, version).collect())
    # One answer of the holdout is changed afterwards.
    name = next(n for n in files.names(spark, f"{version}/eval")
                if n.startswith("part") and files.read_text(spark, f"{version}/eval/{n}"))
    lines = files.read_text(spark, f"{version}/eval/{name}").splitlines()
    row = json.loads(lines[0])
    lines[0] = json.dumps({**row, "response": row["response"] + "!"})
    files.remove(spark, f"{version}/eval/.{name}.crc")
    files.write_text(spark, f"{version}/eval/{name}", "\n".join(lines) + "\n", overwrite=True)
    got = {r["side"]: (r["rows_found"], r["intact"]) for r in plan.check_version(spark, version).collect()}
    assert got == {"eval": (2, False), "kept": (6, True)}


def test_a_split_that_does_not_cover_is_not_published(spark, folder, monkeypatch):
    monkeypatch.setattr(
        plan, "split_holdout",
        lambda rows, *a: tuple(side.limit(1) for side in curate.split_holdout(rows, *a)),
    )
    with pytest.raises(JobFailed, match="not the deduplicated"):
        plan.prepare(spark, config(folder, "bad"))
    assert not files.exists(spark, f"{folder}/data/current")
