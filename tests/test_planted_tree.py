"""The whole way from pointer files to reports, on a planted tree of all five layouts; counts by plain Python."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallybook import operators as op
from tallybook.operators.snapshots import manifest_diff, write_snapshot
from tallybook.plans import build_manifest, leak_free_split
from tallybook.sources import read_manifest, scan_pointers
from tallybook.sources.tree import TreeReader, scan_tree


def planted():
    """path -> (oid, size): gaps, runs of copies, a pair without a partner, a shard that is missing, patients that share a lesion."""
    tree = {}

    def put(path, content, size):
        tree[path] = (hashlib.sha256(content.encode()).hexdigest(), size)

    for label, n in (("MEL", 6), ("NEV", 9)):
        for i in range(1, n + 1):
            if i != 4:
                put(f"fluo_sc/CLI/{label}/CLI_{label}_{i}.jpg", f"c{label}{i}", 1000 + i)
            if i != 2:
                put(f"fluo_sc/FLUO/{label}/FLUO_{label}_{i}.jpg", f"f{label}{i}", 500 + 100 * i)
    for i in (1, 2, 3, 7):
        put(f"oral_images/benign_lesions/{i}.jpg", f"o{i}", 2000 * i)
    put("oral_images/malignant_lesions/1.jpeg", "o1", 2000)
    for patient, lesion, image in ((1, 1, 1), (1, 2, 1), (2, 2, 9), (3, 5, 1), (4, 5, 2), (4, 6, 1), (9, 9, 9)):
        put(f"pad_ufes_20/images/PAT_{patient}_{lesion}_{image}.png", f"p{patient}{lesion}{image}", 9000 + patient)
    for shard, ordinals in ((0, range(0, 10)), (1, [10, 11, 13, 14, 19]), (3, [30, 31])):
        for i in ordinals:
            put(f"pmc_vqa/train-{shard:05d}-of-00005/pmc_train_{i}.jpg", f"v{i // 3}", 100_000 if i == 5 else 10 + i // 3)
    put("scin/-77/image_1.png", "s", 91)
    return tree


TREE = planted()


def write(root, tree):
    for path, (oid, size) in tree.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(f"version https://git-lfs.github.com/spec/v1\noid sha256:{oid}\nsize {size}\n")


@pytest.fixture(scope="module")
def manifest(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    write(root / "raw", TREE)
    build_manifest(spark, str(root / "raw"), str(root / "out"))
    assert spark.read.parquet(str(root / "out" / "quarantine")).count() == 0
    return read_manifest(spark, str(root / "out" / "manifest"))


def of(manifest, origin):
    return manifest.filter(F.col("origin") == origin)


def test_all_pointers_are_read(manifest):
    assert {r.path: (r.oid, r.size) for r in manifest.collect()} == TREE
    case = of(manifest, "scin").first()
    assert (case.case_id, case.image_no, case.ext) == ("-77", 1, "png")


def test_copies(manifest):
    oids = Counter(oid for oid, _ in TREE.values())
    assert {r.oid: r.n for r in op.duplicate_groups(manifest).collect()} == {o: n for o, n in oids.items() if n > 1}
    first = {}
    for path in sorted(TREE):
        first.setdefault(TREE[path][0], path)
    assert {r.oid: r.path for r in op.exact_dedup(manifest, ["path"]).collect()} == first
    shards = defaultdict(set)
    for path, (oid, _) in TREE.items():
        if path.startswith("pmc"):
            shards[oid].add(int(path[14:19]))
    crossing = {(r.oid, r.shard) for r in op.cross_partition_duplicates(of(manifest, "pmc_vqa"), "shard").collect()}
    assert crossing == {(o, s) for o, held in shards.items() for s in held if len(held) > 1} and crossing


def test_gaps_and_shards(manifest):
    pmc = of(manifest, "pmc_vqa")
    assert {tuple(r) for r in op.missing_ranges(pmc, ["shard"], "ordinal").collect()} == {(1, 12, 12, 1), (1, 15, 18, 4)}
    assert {tuple(r) for r in op.missing_shard_ranges(pmc, "shard", "shard_total").collect()} == {(2, 2, 1), (4, 4, 1)}
    assert sorted(r.shard for r in op.missing_shards(pmc, "shard", "shard_total").collect()) == [2, 4]
    islands = {(r.shard, r.start, r.end) for r in op.ordinal_islands(pmc, ["shard"], "ordinal").collect()}
    assert islands == {(0, 0, 9), (1, 10, 11), (1, 13, 14), (1, 19, 19), (3, 30, 31)}
    assert op.misrouted(pmc, "shard", F.floor(F.col("ordinal") / 10)).count() == 0


def test_pairs(manifest):
    fluo = of(manifest, "fluo_sc")
    cli, uv = fluo.filter("modality = 'CLI'"), fluo.filter("modality = 'FLUO'")
    pairs = op.matched_pairs(cli, uv, ["label", "ordinal"], ["path"], ["path", "size"])
    assert Counter(r.label for r in pairs.collect()) == {"MEL": 4, "NEV": 7}
    alone = {(r.side, r.label, r.ordinal) for r in op.unpaired(cli, uv, ["label", "ordinal"]).collect()}
    assert alone == {("left", "MEL", 2), ("left", "NEV", 2), ("right", "MEL", 4), ("right", "NEV", 4)}


def test_patients(manifest):
    pad = of(manifest, "pad_ufes_20")
    groups = defaultdict(set)
    for r in op.linked_groups(pad, "patient", "lesion").collect():
        groups[r.component].add(r.patient)
    assert sorted(map(sorted, groups.values())) == [[1, 2], [3, 4], [9]]
    split = leak_free_split(pad.withColumn("patient", F.col("patient").cast("string")), "patient", "lesion")
    assert split.count() == 7 and op.split_leakage(split, "lesion").count() == 0


def test_reports(manifest):
    formats = {(r.origin, r.kind): r.n for r in op.format_audit(manifest, "origin").collect()}
    assert formats[("oral_images", "jpg")] == 4 and formats[("oral_images", "jpeg")] == 1
    top = {r.origin: r.size for r in op.largest_k(manifest, ["origin"], 1).collect()}
    assert top == {"fluo_sc": 1400, "oral_images": 14000, "pad_ufes_20": 9009, "pmc_vqa": 100_000, "scin": 91}


def test_a_move_between_two_snapshots(spark, manifest, tmp_path):
    """A pointer filed under the next shard, as neighbours of one content lie on both sides of a shard's end."""
    old = "pmc_vqa/train-00001-of-00005/pmc_train_19.jpg"
    new = "pmc_vqa/train-00002-of-00005/pmc_train_20.jpg"
    moved = manifest.withColumn("path", F.when(F.col("path") == old, new).otherwise(F.col("path")))
    write_snapshot(manifest, str(tmp_path / "a"), fanout=3)
    write_snapshot(moved, str(tmp_path / "b"), like=str(tmp_path / "a"))
    found = manifest_diff(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()
    assert [(r.change, r.path, r.old_path, r.oid, r.size) for r in found] == [("moved", new, old, *TREE[old])]


@pytest.mark.parametrize("depth, shares", [(0, 1), (1, 1), (1, 3), (2, 2), (5, 1)])
def test_scan_by_tasks(spark, tmp_path, depth, shares):
    """The driver lists folders only; rows are those of the plain scan, and empty and large files besides."""
    write(tmp_path, TREE)
    (tmp_path / "scin" / "empty").write_bytes(b"")
    (tmp_path / "top").write_bytes(b"x" * 5000)
    (tmp_path / "odd name é%20").write_bytes(b"\xff\xfe")
    found = scan_tree(spark, str(tmp_path), depth, shares)
    rows = {r.path: r for r in found.collect()}
    assert found.count() == len(rows) == len(TREE) + 3
    plain = {r.path: (r.version, r.oid, r.size, r.well_formed) for r in scan_pointers(spark, str(tmp_path)).collect()}
    assert {p: (r.version, r.oid, r.size, r.well_formed) for p, r in rows.items() if p in TREE} == {p: plain[p] for p in TREE}
    assert [(rows[p].well_formed, rows[p].file_size) for p in ("scin/empty", "top", "odd name é%20")] == [(False, 0), (False, 5000), (False, 2)]


def test_the_driver_lists_folders_not_files(tmp_path):
    write(tmp_path, TREE)
    parts = TreeReader({"path": str(tmp_path), "depth": "2"}).partitions()
    assert sorted({p.folder[len(str(tmp_path)) :] for p in parts if p.deep}) == sorted(
        {"/" + "/".join(p.split("/")[:2]) for p in TREE if p.count("/") >= 2}
    )
    assert sum(p.deep for p in parts) < len(TREE) / 4
