"""Tasks list and open snapshot files; the driver's file sources see none of them."""

from pyspark.sql import functions as F

from marketlake.sources import snapshots
from marketlake.streaming import stateful
from test_sources import snapshot, write


def test_documents_are_read_by_name(spark, tmp_path):
    root = tmp_path / "in put"
    write(root / "2026" / "a b%20c.json", snapshot(2))
    write(root / "2026" / "list.json", [snapshot(1), snapshot(3)])
    write(root / "2026" / "empty.json", b"")
    write(root / "2026" / "utf16.json.gz", '{"schema_version": "v1", "captured_at": "ñ"}'.encode("utf-16"))
    write(root / "x" / "cut.json", b'{"schema_version": "v1", "si')
    (root / "x" / "no.json.gz").write_bytes(b"no gzip")
    write(root / "_hidden" / "h.json", snapshot(9))
    write(root / ".h.json", snapshot(9))
    read = snapshots.read_documents(spark, [f"file://{root}"])
    rows = {(r.stem, r.captured_at, r.broken is not None) for r in read.collect()}
    day = "2026-05-06T03:19:07Z"
    assert rows == {("a b%20c", day, False), ("list", day, False), ("empty", None, True), ("utf16", "ñ", False), ("cut", None, True), ("no", None, True)}
    assert snapshots.flatten(read).count() == 6 and snapshots.bad_files(read).first()["n_bad"] == 3
    assert snapshots.listed(spark, [f"file://{root}"]).where(F.col("path").startswith(f"file://{root}/")).count() == 6


def test_a_stream_names_parts_and_takes_each_file_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "FILES", 8)
    root, log, seen = tmp_path / "in", f"file://{tmp_path}/log", []

    def run():
        stateful.to_table(snapshots.document_stream(spark, f"file://{root}", log), lambda batch, n: seen.extend(r.stem for r in batch.select("stem").collect()), f"file://{tmp_path}/cp")

    for k in range(40):
        write(root / f"20260506T03{k:02d}07Z.json", snapshot(1))
    run()
    write(root / "20250506T030007Z.json", snapshot(1))  # older than all
    run()
    run()
    assert len(seen) == len(set(seen)) == 41
    # the checkpoint has a line for each part, not for each file
    taken = "".join(p.read_text() for p in (tmp_path / "cp" / "sources" / "0").iterdir() if not p.name.startswith("."))
    assert "2025" not in taken and 0 < taken.count('"path"') < 25
    # names that were written before a stop are taken by the next run
    write(root / "20260601T030007Z.json", snapshot(1))
    snapshots.document_stream(spark, f"file://{root}", log)
    run()
    assert len(seen) == len(set(seen)) == 42
