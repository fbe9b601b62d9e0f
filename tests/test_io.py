import hashlib
import os

import pytest
from pyspark.sql import functions as F

from faultscore.operators.audit import validate
from faultscore.sources.checksums import block_digest, file_checksums, require_checksum
from faultscore.sources.csv import read_labelled_csv, read_scoring_csv

from faultscore.schema import MACHINE_CSV_TASK

from fixtures import SF001


# Fixed value: the SHA-256 digest of the seven bytes b"sensor\n".
DIGEST = "16dab8f41e9b1f415f75cedcf0b91cc9a907a3a96c83fb279416e9114a082d29"


def test_checksums_of_nested_folders_have_relative_paths(spark, tmp_path):
    for name in ("a.txt", "x/a.txt", "x/y/b.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"sensor\n" if name.endswith("a.txt") else b"x")
    got = {r.path: (r.length, r.sha256) for r in file_checksums(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": (7, DIGEST), "x/a.txt": (7, DIGEST), "x/y/b.txt": (1, hashlib.sha256(b"x").hexdigest())}
    assert file_checksums(spark, str(tmp_path / "x" / "a.txt")).first().path == "a.txt"


def test_checksums_of_a_file_over_two_gib_and_of_an_empty_one(spark, tmp_path):
    size = (2 << 30) + 12345
    with open(tmp_path / "large file.bin", "wb") as f:
        f.truncate(size)  # a hole: takes no disk
        f.seek(size - 7)
        f.write(b"sensor\n")
    (tmp_path / "empty.bin").write_bytes(b"")
    expected = hashlib.sha256()
    for _ in range(size // (1 << 20)):
        expected.update(bytes(1 << 20))
    expected.update(bytes(size % (1 << 20) - 7) + b"sensor\n")
    got = {r.path: (r.length, r.sha256) for r in file_checksums(spark, f"file:{tmp_path}").collect()}
    assert got == {"large file.bin": (size, expected.hexdigest()), "empty.bin": (0, hashlib.sha256(b"").hexdigest())}


def test_a_block_never_changes_a_digest(tmp_path):
    data = bytes(range(256)) * 41
    (tmp_path / "x").write_bytes(data)
    for block in (1, 7, 4096, len(data), len(data) + 1):
        assert block_digest(f"file://{tmp_path}/x", block) == (len(data), hashlib.sha256(data).hexdigest())


def test_checksums_match_hashlib_and_mismatch_raises(spark):
    sums = {os.path.basename(r.path): r.sha256 for r in file_checksums(spark, os.path.join(SF001, "*.parquet")).collect()}
    for name in ("events.parquet", "labels.parquet"):
        with open(os.path.join(SF001, name), "rb") as f:
            assert sums[name] == hashlib.sha256(f.read()).hexdigest()
    checks = file_checksums(spark, os.path.join(SF001, "labels.parquet"))
    manifest = checks.select("path", F.lit("0" * 64).alias("sha256"))
    with pytest.raises(ValueError, match="checksum mismatch"):
        require_checksum(checks, manifest)


HEADER = "UDI,Product ID,Type,Air temperature [K],Process temperature [K],Rotational speed [rpm],Torque [Nm],Tool wear [min],Machine failure,TWF,HDF,PWF,OSF,RNF"


def test_csv_read_by_name_with_bom_reordered_and_extra_columns(spark, scratch):
    spec = MACHINE_CSV_TASK
    cols = HEADER.split(",")
    order = list(reversed(cols)) + ["extra"]
    values = dict(zip(cols, ["1", "L00001", "L", "298.1", "308.6", "1551", "42.8", "0", "0", "0", "0", "0", "0", "0"]))
    values["extra"] = "zzz"
    path = os.path.join(scratch, "data.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write(",".join(order) + "\n" + ",".join(values[c] for c in order) + "\n")
    df = read_labelled_csv(spark, path, spec)
    row = df.first()
    assert row["Torque [Nm]"] == 42.8 and row["Type"] == "L" and row["UDI"] == 1
    assert "extra" not in df.columns
    assert validate(df, spec)["rows"] == 1


def test_csv_inf_and_missing_tokens_reach_the_audit(spark, scratch):
    spec = MACHINE_CSV_TASK
    path = os.path.join(scratch, "bad.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "\n1,L1,L,inf,308,1500,40,10,0,0,0,0,0,0\n2,L2,L,300,308,1500,40,10,0,0,0,0,0,0\n")
    with pytest.raises(ValueError, match="must be finite"):
        validate(read_labelled_csv(spark, path, spec), spec)
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "\n1,L1,L,NA,308,1500,40,10,0,0,0,0,0,0\n2,L2,L,300,308,1500,40,10,0,0,0,0,0,0\n")
    with pytest.raises(ValueError, match="missing values"):
        validate(read_labelled_csv(spark, path, spec), spec)


def test_scoring_csv_keeps_extra_columns(spark, scratch):
    spec = MACHINE_CSV_TASK
    path = os.path.join(scratch, "rows.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Type,Air temperature [K],Process temperature [K],Rotational speed [rpm],Torque [Nm],Tool wear [min],row_id\n")
        f.write("L,298.1,308.6,1551,42.8,0,a\nH,302.4,310.1,1280,67.5,220,b\n")
    df = read_scoring_csv(spark, path, spec)
    assert df.count() == 2 and "row_id" in df.columns
    assert dict(df.dtypes)["Torque [Nm]"] == "double"


def test_missing_csv_column_is_rejected(spark, scratch):
    spec = MACHINE_CSV_TASK
    path = os.path.join(scratch, "short.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("UDI,Type\n1,L\n")
    with pytest.raises(ValueError, match="missing required columns"):
        read_labelled_csv(spark, path, spec)


def _row(**cells):
    values = dict(zip(HEADER.split(","), ["1", "L1", "L", "300", "308", "1500", "40", "10", "0", "0", "0", "0", "0", "0"]))
    return ",".join({**values, **cells}[c] for c in HEADER.split(","))


@pytest.mark.parametrize("cells,message", [
    ({"Machine failure": "0.7"}, "Machine failure"),
    ({"Machine failure": "1.9"}, "Machine failure"),
    ({"Type": " L"}, "Type"),
    ({"Torque [Nm]": "#N/A"}, "missing values"),
    ({"Torque [Nm]": "1.#IND"}, "missing values"),
])
def test_loading_judges_values_as_they_are_written(spark, tmp_path, cells, message):
    path = tmp_path / "rows.csv"
    path.write_text("\n".join([HEADER, _row(UDI="2"), _row(**cells)]) + "\n", encoding="utf-8")
    with pytest.raises(ValueError, match=message):
        read_labelled_csv(spark, str(path), MACHINE_CSV_TASK)


def test_a_loaded_table_splits_by_its_double_target(spark, tmp_path):
    from faultscore.operators.split import split_summary, stratified_split

    path = tmp_path / "rows.csv"
    path.write_text("\n".join([HEADER, *[_row(UDI=str(i), **{"Machine failure": "1" if i % 5 == 0 else "0.0"}) for i in range(100)]]) + "\n", encoding="utf-8")
    table = read_labelled_csv(spark, str(path), MACHINE_CSV_TASK)
    rows = {r.split: (r.rows, r.positive_rows) for r in split_summary(stratified_split(table, MACHINE_CSV_TASK, 1, audit=True), MACHINE_CSV_TASK.target).collect()}
    assert rows == {"train": (60, 12), "validation": (20, 4), "test": (20, 4)}
