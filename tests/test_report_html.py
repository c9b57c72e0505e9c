from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lotseries.functions.text import number, slug, slug_column
from lotseries.operators import report_html as rh

HEAD = ["Zafra", "Lote", "Área (ha)", "Producción", "", "Edad", "Edad", "Nitrógeno %", "Cierre", "Brix", "Ph", "Nota"]
NAMES = ["zafra", "lote", "area_ha", "produccion", "col_4", "edad", "edad_1", "nitrogeno", "cierre", "brix", "ph", "nota"]


def html(rows, tr="tr", td="td"):
    cells = lambda row: "".join(f"<{td} class='x'>{c}</{td}>" for c in row)
    body = "\n".join(f"<{tr} height=20>\n{cells(row)}</{tr}>" for row in rows)
    return f"<html><body><table>\n{body}\n</table></body></html>"


def line(i, **cells):
    row = ["Zafra 2019-2020", f"07-{i:04}", "1.5", str(i), "", "300", "", "1e2", "01/02/2020", " 20 ", "7d", "<b>ok</b> fine"]
    for k, v in cells.items():
        row[NAMES.index(k)] = v
    return row


def test_a_report_file(spark, tmp_path):
    rows = [["Title", "x"], HEAD, line(1), line(2, area_ha="2,5"), [" ", "&nbsp;"[:0], " "], line(3)[:3], line(4) + ["extra"]]
    rows.append(line(5, nota="a b&nbsp;c", edad="-3"))
    path = tmp_path / "sheet001.htm"
    path.write_text(html(rows), encoding="utf-8")
    table = rh.read_report(spark, str(path))
    assert table.columns == NAMES
    assert dict(table.dtypes) == {
        **dict.fromkeys(NAMES, "string"),
        "produccion": "double", "col_4": "double", "edad": "double", "edad_1": "double",
        "nitrogeno": "double", "brix": "double",
    }
    got = sorted(table.collect(), key=lambda r: r.lote)
    assert len(got) == 5 and got[0].nota == "ok fine" and got[0].brix == 20.0 and got[0].nitrogeno == 100.0
    assert got[2].produccion is None and got[2].area_ha == "1.5"  # short row padded
    assert got[4].nota == "a b&nbsp;c" and got[4].edad == -3.0  # entities stay
    assert got[0].ph == "7d"


def test_upper_case_tags_and_a_missing_header(spark, tmp_path):
    (tmp_path / "u.htm").write_text(html([HEAD, line(1), line(2)], "TR", "TD"))
    assert rh.read_report(spark, str(tmp_path / "u.htm")).count() == 2
    (tmp_path / "n.htm").write_text(html([["a", "b"]]))
    with pytest.raises(ValueError, match="at least 10"):
        rh.read_report(spark, str(tmp_path / "n.htm"))


def test_rows_keep_their_order_over_many_splits(spark, tmp_path):
    rows = [["t"], HEAD] + [line(i) for i in range(3000)]
    path = tmp_path / "big.htm"
    path.write_text(html(rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = rh.read_report_rows(spark, str(path))
        assert raw.select("block").distinct().count() > 20
        ordered = raw.orderBy(*rh.POSITION).select(F.get("cells", F.lit(1)).alias("lot")).collect()
        assert [r.lot for r in ordered][2:] == [f"07-{i:04}" for i in range(3000)]
        table = rh.read_report(spark, str(path))
        assert table.count() == 3000 and dict(table.dtypes)["produccion"] == "bigint"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_mixed_case_tags_over_many_ranges(spark, tmp_path):
    rows = [["t"], HEAD] + [line(i, nota="ä" * (i % 50)) for i in range(1500)]
    text = html(rows)
    for k in range(0, 1500, 3):
        text = text.replace(f"<td class='x'>07-{k:04}</td>", f"<TD class='x'>07-{k:04}</Td>")
    pieces = text.split("</tr>")
    text = "".join(p + ("</tr>", "</TR>", "</Tr>")[i % 3] for i, p in enumerate(pieces[:-1])) + pieces[-1].replace("<tr", "<TR")
    for name, end in (("a.htm", ""), ("b.htm", "<tr><td>no end</td>"), ("c.htm", " > </tr> after")):
        (tmp_path / name).write_text(text + end, encoding="utf-8")
    (tmp_path / "d.htm").write_bytes(b"<tr><td>\xff\xfe</td><td>" + b"y" * 90_000 + b"</td></tr><tr><td>z")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = rh.read_report_rows(spark, str(tmp_path))
        assert raw.where("file like '%a.htm'").select("block").distinct().count() > 10
        for name in "abc":
            found = raw.where(f"file like '%{name}.htm'").orderBy(*rh.POSITION).select("cells").collect()
            assert [r.cells[1] for r in found[2:]] == [f"07-{i:04}" for i in range(1500)]
            assert [r.cells[11] for r in found[2:]] == ["ä" * (i % 50) for i in range(1500)]
        last = raw.where("file like '%d.htm'").collect()
        assert [[len(c) for c in r.cells] for r in last] == [[2, 90_000]]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_pieces_without_a_closing_tag_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rh, "MOST_HELD", 50)
    (tmp_path / "r.htm").write_text("<p>" * 100 + html([["a", "b"], ["c" * 200, "d"] * 30, ["e"]]) + "<p>" * 100)
    assert [r.cells for r in rh.read_report_rows(spark, str(tmp_path)).orderBy(*rh.POSITION).collect()] == [["a", "b"], ["c" * 200, "d"] * 30, ["e"]]


def test_slugs(spark):
    names = {"Área (ha)": "area_ha", " % de Infestación/Barrenador ": "de_infestacion_barrenador", "a—b": "ab", "straße ²": "strae_2", "ﬁn": "fin", "": ""}
    assert {n: slug(n) for n in names} == names
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    got = {r[0]: r[1] for r in df.select("n", slug_column(F.col("n"))).collect()}
    assert got == {**names, None: None}
    assert rh.column_names(["a", "A", "", "a", "b"]) == ["a", "a_1", "col_2", "a_2", "b"]


def test_numbers_are_whole_cells(spark):
    cells = {"1": 1.0, "-1.5e3": -1500.0, ".5": 0.5, "5.": 5.0, "inf": float("inf"), "7d": None, "1,5": None, "0x10": None, "1 2": None, "": None, "NaN": None}
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert {r[0]: r[1] for r in df.select("c", number(F.col("c"))).collect()} == cells


def test_pages_in_a_column(spark):
    df = spark.createDataFrame([(1, html([["a", " b "], ["", " "], ["c"]])), (2, "no table")], "id int, html string")
    got = [(r.id, r.pos, r.cells) for r in rh.page_rows(df, "id").collect()]
    assert got == [(1, 0, ["a", "b"]), (1, 2, ["c"])]


def test_from_a_report_file_to_the_master_table(spark, tmp_path):
    from datetime import date

    from lotseries.plans.training import master_table, report_yields

    path = tmp_path / "sheet.htm"
    path.write_text(html([["t"], HEAD, line(1), line(2)]), encoding="utf-8")
    yields = report_yields(rh.read_report(spark, str(path)), ["zafra", "lote", "area_ha", "brix", "cierre"])
    obs = spark.createDataFrame([("07-0001", date(2020, 1, 5)), ("07-0009", date(2020, 1, 5))], "lot_id string, obs_date date")
    rows = {r.lot_id: r for r in master_table(obs, yields).collect()}
    hit, miss = rows["07-0001"], rows["07-0009"]
    assert (hit.harvest, hit.brix, hit.report_season, hit.season) == ("01/02/2020", 20, "Zafra 2019-2020", "2019_2020")
    assert miss.harvest is None and miss.season == "2019_2020"
