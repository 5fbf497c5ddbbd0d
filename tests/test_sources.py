"""Snapshot files, grids, archives and guards on folders written here."""

import datetime
import gzip
import json

from pyspark.sql import functions as F

from marketlake.sources import documents as docs
from marketlake.sources import sinks
from marketlake.sources.snapshots import SnapshotTable, failed_pages, flatten, read_documents


def snapshot(n, version="v1", size="5"):
    ads = [{"ad_id": k, "line": 1, "price4": 70000 + k, "size": size, "trader": k, "banks": [{"identifier": "B1"}, {"identifier": ""}, {}]} for k in range(n)]
    pages = [{"page": 1, "error": None, "response": {"data": ads}}, {"page": 2, "error": "timeout", "response": None}]
    return {"schema_version": version, "captured_at": "2026-05-06T03:19:07Z", "sides": {"BUY": {"pages": pages}, "SELL": {"pages": []}}}


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    data = content if isinstance(content, bytes) else json.dumps(content, indent=1).encode()
    path.write_bytes(gzip.compress(data) if path.name.endswith(".gz") else data)


def test_snapshot_table(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    write(a / "2026" / "05" / "20260506T031907Z_snapshot.json", snapshot(2))
    write(b / "20260506T031907Z_snapshot.json.gz", snapshot(3, size="7"))  # gzip beats plain
    write(a / "20260507T000000Z_snapshot.json.gz", snapshot(4))
    write(b / "20260507T000000Z_snapshot.json.gz", snapshot(9))  # the first root beats the second
    write(a / "20260508T000000Z_snapshot.json", snapshot(5, version="v9"))  # no rows
    write(a / "20260509T000000Z_snapshot.json", b'{"schema_version": "v1", "si')  # broken
    write(a / "20260510T000000Z_snapshot.json", snapshot(1, size="none"))
    table = SnapshotTable(spark, [f"file://{a}", f"file://{b}"], f"file://{tmp_path}/ads")
    for _ in range(2):  # a second rebuild gives the same
        load = table.rebuild()
        assert (load.watermark, load.files, load.failed, load.rows) == ("20260510T000000Z_snapshot", 5, 1, 8)
        counts = {r.stem[:8]: (r.n, r.depth) for r in table.rows().groupBy("stem").agg(F.count("*").alias("n"), F.sum("size").alias("depth")).collect()}
        assert counts == {"20260506": (3, 21), "20260507": (4, 20), "20260510": (1, None)}
    assert table.rows().select("banks").distinct().collect()[0].banks == ["B1"]

    write(a / "20260511T000000Z_snapshot.json", snapshot(6))
    assert table.status()["pending"] == 1
    load = table.load_new()
    assert (load.watermark, load.files, load.rows) == ("20260511T000000Z_snapshot", 1, 6)
    assert table.load_new().files == 0
    write(a / "20260507T000000Z_snapshot.json.gz", snapshot(2))
    load = table.reload_since("2026-05-07")
    assert (load.watermark, load.files, load.failed) == ("20260511T000000Z_snapshot", 5, 1)
    assert table.status() == {"watermark": "20260511T000000Z_snapshot", "files": 6, "pending": 0, "rows": 12, "snapshots": 1}


def test_snapshot_table_has_no_folder_for_each_stem(spark, tmp_path):
    """A folder and a file for each of a hundred thousand stems take longer than their rows."""
    for k in range(40):
        write(tmp_path / "in" / f"20260506T03{k:02d}07Z_snapshot.json", snapshot(2))
    table = SnapshotTable(spark, [f"file://{tmp_path}/in"], f"file://{tmp_path}/out")
    assert table.rebuild().rows == table.rebuild().rows == 80
    assert len(list((tmp_path / "out" / "ads").rglob("*.parquet"))) < 20
    # a load that stopped before its record isn't seen
    table.rows().limit(1).write.parquet(f"file://{tmp_path}/out/ads/base=1/load=2")
    assert table.rows().count() == table.status()["rows"] == 80
    write(tmp_path / "in" / "20260506T030007Z_snapshot.json", snapshot(5))
    assert table.reload_since("2026-05-06").rows == 83 and table.rows().count() == 83


def test_documents_go_to_files_in_small_batches(spark, tmp_path):
    from marketlake.plans.files import DOCUMENTS, snapshot_files

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        snapshot_files(spark, "/root/testdata/sf0.001", f"file://{tmp_path}/in")
        assert int(spark.conf.get(name)) <= DOCUMENTS and list((tmp_path / "in").rglob("*.json.gz"))
    finally:
        spark.conf.set(name, before)


def test_failed_pages_stay_visible(spark, tmp_path):
    write(tmp_path / "20260506T031907Z_snapshot.json", snapshot(2))
    read = read_documents(spark, [f"file://{tmp_path}"])
    assert flatten(read).count() == 2
    assert sorted((r.side, r.page, r.error) for r in failed_pages(read).collect()) == [("BUY", 2, "timeout"), ("SELL", None, None)]


def test_incremental_load_needs_a_watermark(spark, tmp_path):
    import pytest

    write(tmp_path / "in" / "20260506T031907Z_snapshot.json", snapshot(2))
    with pytest.raises(ValueError, match="rebuild first"):
        SnapshotTable(spark, [f"file://{tmp_path}/in"], f"file://{tmp_path}/ads").load_new()


def grid(spark, rows):
    cells = [("s", r, c, t) for r, line in enumerate(rows) for c, t in enumerate(line) if t is not None]
    return spark.createDataFrame(cells, "sheet string, row int, col int, text string")


def test_grids(spark):
    years = grid(spark, [["2023"], ["I Trimestre"], [None], ["2024 (p)"], ["II Trimestre"], ["nota"], ["Fuente: x"], ["2025"]])
    assert [tuple(r) for r in docs.year_rows(years).orderBy("row").select("periodo", "preliminary").collect()] == [("2023", False), ("2023-Q1", False), ("2024", True), ("2024-Q2", True)]
    months = grid(spark, [["ENERO", "1"], ["TOTAL", "9"], ["Marzo", "3"], ["Fuente", None], ["ABRIL", "4"]])
    assert [(r.month, r.text) for r in docs.month_rows(months).where("col = 1").orderBy("month").collect()] == [(1, "1"), (3, "3")]
    bands = grid(spark, [[None, None, "2023", None, "2024p)", None], ["Div", "x", "ENERO", "FEBRERO", "ENERO", "TOTAL"]])
    assert [(r.col, r.periodo) for r in docs.two_band_periods(bands, 0, 1).orderBy("col").collect()] == [(2, "2023-01"), (3, "2023-02"), (4, "2024-01")]
    lines = [("Servicios", False), ("de agua", True), ("Comercio", True), ("Otros", False), ("Varios", False), (None, False), ("x", True)]
    labels = spark.createDataFrame([("s", k, t, v) for k, (t, v) in enumerate(lines)], "sheet string, row int, label string, valued boolean")
    assert [r.label for r in docs.joined_labels(labels).orderBy("row").collect()] == ["Servicios de agua", "Comercio", "Varios x"]


def test_html_sources(spark):
    html = "<table><tr><th>Banco</th><th>30-dic</th><th>2-ene</th><th>x</th></tr><tr><td>Promedio ponderado</td><td>9,10</td><td>—</td><td>1,00</td></tr></table>"
    page = spark.createDataFrame([(1, "https://h/a/", html), (2, "https://h/a/", "<p>none</p>")], "page_id long, url string, html string")
    rows = docs.html_rows(page)
    assert [tuple(r) for r in docs.transposed_values(rows, "promedio").collect()] == [(1, datetime.date(2025, 12, 30), 9.1)]
    links = spark.createDataFrame([(1, "https://h/a/", '<h2><a href="/n/1">Un titular bastante largo</a></h2><h3><a class="x" href="n2">Otro titular también largo</a></h3><a href="/no">Un enlace que no es titular</a><h2><a href="/n/1">Otra vez el mismo enlace</a></h2><h2><a href="/c">corto</a></h2>')], "page_id long, url string, html string")
    assert [(r.place, r.title, r.link) for r in docs.heading_links(links).collect()] == [(0, "Un titular bastante largo", "https://h/n/1"), (1, "Otro titular también largo", "https://h/a/n2")]


def test_shard_faults(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 0)], "grp string, v int")
    index = sinks.write_shards(rows, "grp", f"file://{tmp_path}/s")
    shards = spark.read.parquet(f"file://{tmp_path}/s/shards")
    assert [(r.grp, r.fault) for r in sinks.shard_faults(index, shards, "grp", F.col("v") > 0).collect()] == [("b", "contract")]
    assert [(r.grp, r.fault) for r in sinks.shard_faults(index.where("grp = 'a'"), shards, "grp", F.lit(True)).collect()] == [("b", "not in the index")]


def test_document_too_large(spark):
    import pytest

    rows = spark.createDataFrame([(1, "x" * 50)], "k int, t string")
    made = sinks.one_document({"rows": rows, "none": rows.limit(0)}, {"rows": "k", "none": "k"}, 200).first()
    assert json.loads(made.document) == {"rows": [{"k": 1, "t": "x" * 50}], "none": []} and made.bytes == len(made.document)
    with pytest.raises(Exception, match="bytes"):
        sinks.one_document({"rows": rows}, {"rows": "k"}, 20).collect()
