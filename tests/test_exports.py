"""HTML exports: the largest table, its header and the sale above it."""

from lotwise.sources import exports


def table(rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def test_html_exports(spark, tmp_path):
    top = [["x"], ["", "Nombre de subasta:", "Madrid &amp; Sur"], [], [], ["", "", "", "", "Fecha", "01/02/2024"], []]
    lots = [["Nº  Lote", "Marca", "Marca", ""], ["7", "Seat", "SEAT", "a<br>b", "beyond"], ["", "", ""], ["8", "Citroën"]]
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.xls").write_text("<p>menu</p>" + table([["small"]]) + table(top + lots), encoding="utf-8")
    (tmp_path / "sub" / "b.xlsx").write_bytes(table([["uno", "dos"], ["Peñíscola"]]).encode("latin-1"))
    (tmp_path / "c.html").write_text("no table")
    (tmp_path / "d.xlsx").write_bytes(b"PK\x03\x04 a true workbook <table><tr><td>x</td></tr></table>")
    (tmp_path / "e.xls").write_bytes(b"")
    got = {}
    for r in exports.html_exports(spark, str(tmp_path)).orderBy("path", "row").collect():
        got.setdefault(r["path"].rsplit("/", 1)[-1], []).append((r["cells"], r["nombre_subasta"], r["fecha_subasta"]))
    sale = ("Madrid & Sur", "01/02/2024")
    assert got["a.xls"] == [({"Nº Lote": "7", "Marca": "SEAT", "3": "a b"}, *sale), ({"Nº Lote": "8", "Marca": None, "3": None}, *sale)]
    assert got["b.xlsx"] == [({"0": "uno", "1": "dos"}, None, None), ({"0": "Peñíscola", "1": None}, None, None)]
    assert set(got) == {"a.xls", "b.xlsx"}
