"""Planted faults in pointer files, payloads and paths."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallybook.operators import quarantine, validate_manifest, verify_payloads
from tallybook.plans import build_manifest, checked_pointers
from tallybook.sources import (
    POINTER_VERSION,
    misfit_files,
    read_manifest,
    scan_payloads,
    scan_pointers,
    write_manifest,
)
from tallybook.streaming import ingest_new_pointers

OID = hashlib.sha256(b"blob").hexdigest()


def pointer(version=POINTER_VERSION, oid=OID, size="4", end="\n"):
    return f"version {version}\noid sha256:{oid}\nsize {size}{end}".encode()


def put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content)


FAULTS = {
    "oral_images/benign_lesions/1.jpg": (pointer(), None),
    "oral_images/benign_lesions/2.jpg": (pointer(size=str(2**31 + 5)), None),
    "oral_images/benign_lesions/3.jpg": (pointer(version="https://example.org/spec/v9"), "bad version"),
    "oral_images/benign_lesions/4.jpg": (pointer(oid=OID[:63]), "bad oid"),
    "oral_images/benign_lesions/5.jpg": (pointer(oid=OID.upper()), "bad oid"),
    "oral_images/benign_lesions/6.jpg": (pointer(size="0"), "size not positive"),
    "oral_images/benign_lesions/7.jpg": (pointer(size="-3"), "size not positive"),
    "oral_images/benign_lesions/8.jpg": (pointer(size="many"), "bad size"),
    "oral_images/benign_lesions/9.jpg": (pointer(size="9" * 30), "bad size"),
    "oral_images/benign_lesions/10.jpg": (pointer(end=""), "bad layout"),
    "oral_images/benign_lesions/11.jpg": (pointer().replace(b"\n", b"\r\n"), "bad version"),
    "oral_images/benign_lesions/12.jpg": (b"\xff\xd8\xff\xe0" + bytes(range(256)), "bad version"),
    "oral_images/benign_lesions/13.jpg": (b"", "bad version"),
    "oral_images/other/1.jpg": (pointer(), "no rule for path"),
    "elsewhere/1.jpg": (pointer(), "no rule for path"),
    "fluo_sc/CLI/MEL/CLI_MEL_1.jpg": (pointer(), None),
    "fluo_sc/CLI/MEL/CLI_NEV_1.jpg": (pointer(), "name disagrees"),
    "fluo_sc/CLI/MEL/FLUO_MEL_1.jpg": (pointer(), "name disagrees"),
    "pmc_vqa/train-00001-of-00039/pmc_train_9075.jpg": (pointer(), None),
    "pmc_vqa/train-1-of-39/pmc_train_9075.jpg": (pointer(), "no rule for path"),
    "pad_ufes_20/images/PAT_1_2_3.png": (pointer(), None),
    "scin/-12/image_1.png": (pointer(), None),
}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "a folder" / "raw%20tree"
    for path, (content, _) in FAULTS.items():
        put(root, path, content)
    put(root, "oral_images/benign_lesions/14.jpg", b"\xff\xd8" * 5000)
    return root


def test_each_fault_has_its_reason(spark, tree):
    checked = checked_pointers(scan_pointers(spark, str(tree)))
    found = {r.path: r.reason for r in checked.collect()}
    # Spark has no row for an empty file; the build below accounts for it.
    assert found == {path: reason for path, (content, reason) in FAULTS.items() if len(content)}


def test_size_beyond_two_gigabytes_is_kept(spark, tree):
    row = scan_pointers(spark, str(tree)).filter("path like '%benign_lesions/2.jpg'").first()
    assert row["size"] == 2**31 + 5


def test_attributes(spark, tree):
    rows = {r.path: r for r in checked_pointers(scan_pointers(spark, str(tree))).collect()}
    pmc = rows["pmc_vqa/train-00001-of-00039/pmc_train_9075.jpg"]
    assert (pmc.origin, pmc.shard, pmc.shard_total, pmc.ordinal, pmc.label) == ("pmc_vqa", 1, 39, 9075, None)
    pad = rows["pad_ufes_20/images/PAT_1_2_3.png"]
    assert (pad.patient, pad.lesion, pad.image_no, pad.ext) == (1, 2, 3, "png")
    mel = rows["fluo_sc/CLI/MEL/CLI_MEL_1.jpg"]
    assert (mel.modality, mel.label, mel.ordinal) == ("CLI", "MEL", 1)


def test_misfits_are_reported_not_read(spark, tree):
    assert sorted(tuple(r) for r in misfit_files(spark, str(tree)).collect()) == [
        ("oral_images/benign_lesions/14.jpg", 10000),
    ]


def test_build_divides_good_from_bad(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    build_manifest(spark, str(tree), out)
    good = {r.path for r in read_manifest(spark, f"{out}/manifest").collect()}
    assert good == {p for p, (_, reason) in FAULTS.items() if reason is None}
    bad = {r.path: r.reason for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert bad["oral_images/benign_lesions/14.jpg"] == "not a pointer"
    assert set(bad) == {p for p, (_, reason) in FAULTS.items() if reason} | {"oral_images/benign_lesions/14.jpg"}
    assert {p for p, (content, _) in FAULTS.items() if not content} == {p for p, r in bad.items() if r == "empty or missing"}


def test_build_by_folder_against_an_inventory(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    inventory = spark.createDataFrame([("oral_images/benign_lesions/1.jpg",), ("oral_images/gone.jpg",)], "path string")
    build_manifest(spark, str(tree), out, subdirs=["oral_images"], inventory=inventory)
    paths = {r.path for r in spark.read.parquet(f"{out}/checked").collect()}
    assert paths and all(p.startswith("oral_images/") for p in paths)
    bad = {r.path: r.reason for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert bad["oral_images/gone.jpg"] == "empty or missing" and "oral_images/benign_lesions/1.jpg" not in bad


def test_root_that_repeats_in_the_path(spark, tmp_path):
    root = tmp_path / "data"
    put(root, f"x{tmp_path}/data/oral_images/benign_lesions/1.jpg", pointer())
    assert [r.path for r in scan_pointers(spark, str(root)).collect()] == [f"x{tmp_path}/data/oral_images/benign_lesions/1.jpg"]


def test_quarantine_loses_no_row(spark, tree):
    checked = checked_pointers(scan_pointers(spark, str(tree)))
    valid, faulty = quarantine(checked)
    assert valid.count() + faulty.count() == checked.count()


def test_null_check_is_a_fault(spark):
    df = spark.createDataFrame(
        [(None, None, 1, True, None)], "version string, oid string, size bigint, well_formed boolean, path_problem string"
    )
    assert validate_manifest(df).first().reason == "bad version"


def test_payload_states(spark, tmp_path):
    blobs = tmp_path / "blobs"
    put(blobs, "a/ok", b"good")
    put(blobs, "a/short", b"go")
    put(blobs, "a/other", b"evil")
    oid = hashlib.sha256(b"good").hexdigest()
    manifest = spark.createDataFrame(
        [(f"a/{name}", oid, 4) for name in ("ok", "short", "other", "gone")], "path string, oid string, size bigint"
    )
    found = verify_payloads(manifest, scan_payloads(spark, str(blobs)))
    assert {r.path: r.status for r in found.collect()} == {
        "a/ok": "ok", "a/short": "wrong size", "a/other": "wrong hash", "a/gone": "missing"
    }
    bare = spark.createDataFrame([("a/ok", None, None), ("a/short", oid, None)], "path string, oid string, size bigint")
    assert {r.status for r in verify_payloads(bare, scan_payloads(spark, str(blobs))).collect()} == {"no declaration"}


def test_large_origin_is_cut_over_files(spark, tmp_path, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("origin"),
        F.col("id").alias("ordinal"),
        F.format_string("p/%06d", "id").alias("path"),
    )
    out = tmp_path / "m"
    write_manifest(df, str(out))
    assert len(list((out / "origin=large").glob("*.parquet"))) >= 4
    assert spark.read.parquet(str(out)).count() == 20_000


def test_stream_takes_each_file_once(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for i in range(5):
        put(root, f"oral_images/benign_lesions/{i}.jpg", pointer(size=str(i + 1)))
    ingest_new_pointers(spark, str(root), out, state, max_files_per_trigger=2).awaitTermination()
    assert read_manifest(spark, f"{out}/manifest").count() == 5
    put(root, "oral_images/malignant_lesions/1.jpg", pointer())
    put(root, "oral_images/malignant_lesions/2.jpg", pointer(oid="x"))
    put(root, "oral_images/malignant_lesions/3.jpg", b"\xff" * 10_000)
    ingest_new_pointers(spark, str(root), out, state).awaitTermination()
    assert len({r.path for r in read_manifest(spark, f"{out}/manifest").collect()}) == 6
    assert read_manifest(spark, f"{out}/manifest").count() == 6
    bad = {r.path: r.reason for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert bad == {"oral_images/malignant_lesions/2.jpg": "bad oid", "oral_images/malignant_lesions/3.jpg": "not a pointer"}


def test_build_listed_by_tasks_is_the_same(spark, tmp_path):
    root = tmp_path / "raw"
    for path, (content, _) in FAULTS.items():
        put(root, path, content)
    put(root, "oral_images/benign_lesions/99.jpg", b"x" * 5000)
    inventory = spark.createDataFrame([(p,) for p in [*FAULTS, "scin/-12/image_2.png"]], "path string")
    for out, how in (("a", {}), ("b", {"depth": 2}), ("c", {"depth": 0})):
        build_manifest(spark, str(root), str(tmp_path / out), inventory=inventory, **how)

    def rows(out):
        manifest = sorted(map(str, read_manifest(spark, str(tmp_path / out / "manifest")).collect()))
        return manifest, sorted(map(tuple, spark.read.parquet(str(tmp_path / out / "quarantine")).select("path", "reason").collect()))

    assert rows("a") == rows("b") == rows("c")
    with pytest.raises(ValueError):
        build_manifest(spark, str(root), str(tmp_path / "d"), subdirs=["scin"], depth=1)
