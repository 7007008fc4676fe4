"""Sources on small files, compared with hand-made results or a plain single-machine parse."""

import csv
import hashlib
import json
import random
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from lonja.sources import files, located_csv, stock_pages, tables, tariffs, xml_elements
from lonja.session import materialized
from lonja.vocabulary import CATALOGUE_COLUMNS, ORDER_COLUMNS


def plain(path, separator, encoding):
    """Reference result by the csv module over the whole file."""
    with open(path, encoding=encoding, newline="") as stream:
        reader = csv.reader(stream, delimiter=separator, strict=True)
        next(reader)
        rows = []
        while True:
            start = reader.line_num + 1
            row = next(reader, None)
            if row is None:
                return rows
            end = reader.line_num
            rows.append((str(start) if start == end else f"{start}-{end}", row))


@pytest.mark.parametrize("chunk", [7, 40, 1 << 20])
def test_located_csv_cuts_anywhere(spark, tmp_path, chunk):
    random.seed(chunk)
    pieces = ["a", 'in"ch', "línea\r\nuna", 'q"q', "", " x ", "a;b", "\n\n", '"', '""', "ñ" * 30]
    path = tmp_path / "c.csv"
    with open(path, "w", encoding="latin-1", newline="") as stream:
        writer = csv.writer(stream, delimiter=";")
        writer.writerow(CATALOGUE_COLUMNS)
        for i in range(60):
            writer.writerow([random.choice(pieces) for _ in range(random.choice([11, 11, 3]))])
            if i % 9 == 0:
                stream.write("\r\n")
        stream.write('tail;1/2" pipe;x\r\n')
    got = tables.scan_catalogue(spark, str(path), chunk).orderBy("ord").collect()
    assert [r.problem for r in got] == [None] * len(got)
    assert [(r.locator, r.cells) for r in got] == plain(path, ";", "latin-1")


def test_small_tariff_documents_share_tasks(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"{i}.xml").write_text("<TarifasProveedor><Descuentos/><Excepciones/></TarifasProveedor>")
    found = xml_elements.read_elements(spark, str(tmp_path))
    assert found.count() == 100 and len(found.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism


def test_records_of_a_csv_source_are_joined_with_nothing(spark, tmp_path):
    """Spark takes the records for as small as the rows of their chunks; in a join it would send them to the driver."""
    for name in ("b", "a"):
        (tmp_path / f"{name}.csv").write_text(";".join(CATALOGUE_COLUMNS) + f"\n{name};1\n")
    got = tables.scan_catalogue(spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.partition("MapInArrow")[0]
    assert [(r.locator, r.cells) for r in got.orderBy("ord").collect()] == [("a.csv:2", ["a", "1"]), ("b.csv:2", ["b", "1"])]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("chunk", [9, 64, 1 << 20])
def test_line_ends_and_plain_chunks(spark, tmp_path, monkeypatch, end, chunk):
    """Chunks with and without quotes in one file, blank lines, a last line without an end; in blocks of a few bytes."""
    for module in (located_csv, files):
        monkeypatch.setattr(module, "BLOCK", 5)
    monkeypatch.setattr(located_csv, "PIECE", 30)
    rng = random.Random(chunk)
    lines = [",".join(ORDER_COLUMNS)]
    for i in range(90):
        lines.append(",".join(rng.choice(["ñ", "", " b", "ccc"]) for _ in range(rng.choice([9, 9, 2]))) if i % 7 else "")
        if 30 < i < 40:
            lines[-1] += f',"q{end}""{i}"'
    for name, last in (("open", "x,y"), ("closed", "")):
        path = tmp_path / f"{name}.csv"
        path.write_bytes(end.join([*lines, last]).encode())
        got = list(located_csv._records(str(path), 0, path.stat().st_size, 0, 0, False, 1 << 30, ",", "utf-8", ORDER_COLUMNS))
        expected = plain(path, ",", "utf-8")
        assert [(str(r[2]) if r[2] == r[3] else f"{r[2]}-{r[3]}", r[4]) for r in got] == expected
        rows = tables.scan_orders(spark, str(path), chunk).orderBy("ord").collect()
        assert [(r.locator, r.cells) for r in rows] == expected and len({r.ord for r in rows}) == len(rows)


def test_bare_cr_is_read_in_bounded_chunks(tmp_path):
    """No chunk of a file without LF holds more than its own lines."""
    path = tmp_path / "r.csv"
    path.write_bytes((",".join(ORDER_COLUMNS) + "\r").encode() + b"a,b,c\r" * 400_000)
    with files.open_file(str(path)) as stream:
        for start in range(0, path.stat().st_size, 1 << 18):
            first, data = located_csv._region(stream, start, 1 << 18, path.stat().st_size)
            assert len(data) <= (1 << 18) + 6 and (first == 0 or first >= start) and data.endswith(b"\r")


def test_csv_contract(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_bytes(b"\xef\xbb\xbf" + ",".join(ORDER_COLUMNS).encode() + b"\r\nA,1\r\n\r\nB")
    rows = tables.scan_orders(spark, str(path)).orderBy("ord").collect()
    assert [(r.locator, r.cells) for r in rows] == [("2", ["A", "1"]), ("3", []), ("4", ["B"])]
    path.write_text("a,b\n1,2\n")
    assert [r.problem for r in tables.scan_orders(spark, str(path)).collect()] == ["INVALID_HEADER"]
    path.write_bytes(b"")
    assert [r.problem for r in tables.scan_orders(spark, str(path)).collect()] == ["INVALID_HEADER"]
    path.write_bytes(",".join(ORDER_COLUMNS).encode() + b'\nA,"x" y,1\n')
    scanned = tables.scan_orders(spark, str(path))
    assert [(r.problem, r.locator) for r in tables.structural_problems(scanned).collect()] == [("INVALID_CSV", "2")]
    path.write_bytes(",".join(ORDER_COLUMNS).encode() + b"\nA,\xff,1\n")
    assert [r.problem for r in tables.scan_orders(spark, str(path)).collect()] == ["INVALID_ENCODING"]


def test_many_files_have_unique_positions(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(",".join(ORDER_COLUMNS) + f"\n{name},1\n{name},2\n")
    rows = tables.scan_orders(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r.locator for r in rows] == ["a.csv:2", "a.csv:3", "b.csv:2", "b.csv:3"]
    assert len({r.ord for r in rows}) == 4


TARIFF = """<?xml version="1.0" encoding="UTF-8"?>
<TarifasProveedor>
  <Condiciones><Embalaje divisa='GBP'>18.75</Embalaje><Recogida>martes</Recogida></Condiciones>
  <Descuentos>
    <Descuento tipo="categoria" valor="Cestas &amp; mimbre"><PorcentajeBase>7</PorcentajeBase><PorVolumen desdeUnidades="36">9</PorVolumen></Descuento>
    <Descuento tipo="marca" valor="Alfar Luna"><PorcentajeBase>3<z/></PorcentajeBase></Descuento>
    <Descuento valor="Junco" tipo="marca"><!-- hueco --><PorcentajeBase>4</PorcentajeBase><Sobra>8</Sobra></Descuento>
  </Descuentos>
  <Excepciones>
    <Producto sku="ces-77"><PrecioNetoAcordado>6.15</PrecioNetoAcordado><AplicaDescuentoAdicional>false</AplicaDescuentoAdicional></Producto>
    <Producto sku="CES-78"/>
  </Excepciones>
</TarifasProveedor>
"""


def test_tariff_scan(spark, tmp_path):
    path = tmp_path / "t.xml"
    path.write_text(TARIFF, encoding="utf-8")
    elements = tariffs.read_elements(spark, str(path))
    rules = tariffs.scan_rules(elements).orderBy("ord").collect()
    assert [r.locator for r in rules] == [f"/TarifasProveedor/Descuentos/Descuento[{i}]" for i in (1, 2, 3)]
    assert [(r.kind, r.label, r.bases, r.base_text, r.nested, r.other_children, r.volumes) for r in rules] == [
        ("categoria", "Cestas & mimbre", 1, "7", False, 0, 1), ("marca", "Alfar Luna", 1, "3", True, 0, 0),
        ("marca", "Junco", 1, "4", False, 1, 0)]
    entries = tariffs.scan_exceptions(elements).orderBy("ord").collect()
    assert [(r.sku, r.prices, r.price_text, r.flags, r.flag_text) for r in entries] == [
        ("ces-77", 1, "6.15", 1, "false"), ("CES-78", 0, None, 0, None)]
    conditions = tariffs.scan_conditions(elements).orderBy("locator").collect()
    assert [r.locator for r in conditions] == ["/TarifasProveedor/Condiciones/*[1]", "/TarifasProveedor/Condiciones/*[2]"]
    # Markup as it is written out again, with the text up to the next element.
    assert [r.excerpt for r in conditions] == ['<Embalaje divisa="GBP">18.75</Embalaje>', "<Recogida>martes</Recogida>"]
    assert rules[0].excerpt == (
        '<Descuento tipo="categoria" valor="Cestas &amp; mimbre"><PorcentajeBase>7</PorcentajeBase>'
        '<PorVolumen desdeUnidades="36">9</PorVolumen></Descuento>\n    ')
    assert rules[0].volume_excerpts == ['<PorVolumen desdeUnidades="36">9</PorVolumen>']
    assert rules[2].excerpt.startswith('<Descuento valor="Junco" tipo="marca"><PorcentajeBase>4<')
    assert entries[1].excerpt == '<Producto sku="CES-78" />\n  '


def test_elements_cut_anywhere(spark, tmp_path, monkeypatch):
    """A document read in tiny blocks has the elements of the whole one; long markup is cut at the ledger width."""
    rules = "".join(
        f'<Descuento tipo="marca" valor="ñ{i}"><PorcentajeBase>{i}</PorcentajeBase>{"<PorVolumen>1</PorVolumen>" * (i * 9)}</Descuento>\n'
        for i in range(9))
    text = f"<TarifasProveedor><Descuentos>{rules}</Descuentos><Excepciones/></TarifasProveedor>"
    (tmp_path / "t.xml").write_text(text, encoding="utf-8")
    root = ElementTree.fromstring(text)
    whole = [(i, ElementTree.tostring(e, encoding="unicode")[:512], len(e)) for i, e in enumerate(root[0], 1)]
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(xml_elements, "BLOCK", size)
        rows = list(xml_elements._document(str(tmp_path / "t.xml")))
        assert [(r["position"], r["excerpt"], len(r["children"])) for r in rows[:-1]] == whole
        assert rows[-1] == {"path": str(tmp_path / "t.xml"), "problem": None, "root": "TarifasProveedor", "sections": ["Descuentos", "Excepciones"]}


def test_tariff_structure(spark, tmp_path):
    cases = {
        "good": (TARIFF.encode(), None),
        "bom": (b"\xef\xbb\xbf" + TARIFF.encode(), None),
        "latin": (TARIFF.replace("Alfar", "Ñ").encode("latin-1"), "INVALID_ENCODING"),
        "declared": (TARIFF.replace("UTF-8", "ISO-8859-1").encode(), "INVALID_ENCODING"),
        "doctype": (TARIFF.replace("<TarifasP", "<!DOCTYPE x><TarifasP", 1).encode(), "INVALID_XML"),
        "broken": (TARIFF.replace("</Descuentos>", "").encode(), "INVALID_XML"),
        "late": (TARIFF.replace("</Descuentos>", "").encode() + b"\xff", "INVALID_ENCODING"),
        "root": (TARIFF.replace("TarifasProveedor", "Otro").encode(), "INVALID_XML"),
        "extra": (TARIFF.replace("<Excepciones>", "<Mas/><Excepciones>").encode(), "INVALID_XML"),
        "twice": (TARIFF.replace("<Condiciones>", "<Descuentos/><Condiciones>").encode(), "INVALID_XML"),
        "none": (b"<TarifasProveedor><Descuentos/></TarifasProveedor>", "INVALID_XML"),
        "stranger": (TARIFF.replace("<Producto sku", "<Cosa/><Producto sku", 1).encode(), "INVALID_TARIFF"),
    }
    for name, (content, _) in cases.items():
        (tmp_path / f"{name}.xml").write_bytes(content)
    rows = tariffs.structure_problems(tariffs.read_elements(spark, str(tmp_path))).collect()
    got = {r.path.rsplit("/", 1)[1][:-4]: r.problem for r in rows}
    assert got == {name: problem for name, (_, problem) in cases.items()}


def page(number, rows, total, size=2, **meta):
    pages = -(-total // size)
    body = {"page": number, "per_page": size, "total_records": total, "total_pages": pages, "has_next": number < pages}
    return {"data": rows, "meta": body | meta}


def stock(sku, quantity=31):
    return {"sku": sku, "warehouse": "north-2", "quantity": quantity, "reserved": 0, "updated_at": "2024-06-30T12:00:00+02:00"}


def problems(spark, folder, pages):
    folder.mkdir()
    for i, content in enumerate(pages):
        (folder / f"{i}.json").write_text(json.dumps(content))
    found = stock_pages.page_problems(stock_pages.read_pages(spark, str(folder)), 2).collect()
    return sorted(r.problem for r in found)


def test_stock_pages(spark, tmp_path):
    good = [page(1, [stock("cup"), stock(12)], 3), page(2, [stock("pot", "4.250")], 3)]
    assert problems(spark, tmp_path / "good", good) == []
    rows = stock_pages.scan_snapshot(stock_pages.read_pages(spark, str(tmp_path / "good"))).orderBy("ord").collect()
    assert [(r.locator, r.sku, r.quantity) for r in rows] == [
        ("page:1/row:1", "cup", "31"), ("page:1/row:2", None, "31"), ("page:2/row:1", "pot", "4.250")]
    assert problems(spark, tmp_path / "empty", [page(1, [], 0)]) == []
    assert problems(spark, tmp_path / "short", good[:1]) == ["incomplete snapshot"]
    assert "repeated page" in problems(spark, tmp_path / "repeat", [page(1, [stock("A")] * 2, 4), page(2, [stock("A")] * 2, 4)])
    assert "inconsistent page" in problems(spark, tmp_path / "type", [page(1, [stock("A")], 1, page="1")])
    assert "inconsistent page" in problems(spark, tmp_path / "next", [page(1, [stock("A")], 1, has_next=True)])
    assert "incomplete snapshot" in problems(spark, tmp_path / "total", [page(1, [stock("A")] * 2, 3), page(2, [stock("B")], 4)])


def test_numbers_stay_as_written(spark, tmp_path):
    records = [
        '{"sku": "a\\"1,2", "warehouse": "w", "quantity": 9223372036854775807, "reserved": true, "updated_at": "x"}',
        '{"sku": "b", "warehouse": 3, "quantity": 1e3, "reserved": 4.0, "updated_at": null}',
        '{"sku": "c", "warehouse": "5e1", "quantity": 25e-1, "reserved": 1.5E1, "updated_at": {"at": 6}}',
        '{"sku": "d", "quantity": 0.00000012e-1, "reserved": [7], "updated_at": "2:3"}', "8", "[9]", "true", "null", '"text"', "2.5",
    ]
    meta = f'{{"page": 1, "per_page": 10, "total_records": {len(records)}, "total_pages": 1, "has_next": false}}'
    (tmp_path / "p.json").write_text('{"data": [' + ", ".join(records) + '], "meta": ' + meta + "}")
    pages = stock_pages.read_pages(spark, str(tmp_path / "p.json"))
    assert stock_pages.page_problems(pages, 10).count() == 0
    rows = stock_pages.scan_snapshot(pages).orderBy("ord").collect()
    assert [(r.sku, r.warehouse, r.quantity, r.reserved, r.updated_at) for r in rows[:4]] == [
        ('a"1,2', "w", "9223372036854775807", None, "x"), ("b", None, "1E+3", "4.0", None), ("c", "5e1", "2.5", "15", None),
        ("d", None, "1.2E-8", None, "2:3")]
    assert rows[0].excerpt == r'{"sku": "a\"1,2", "warehouse": "w", "quantity": "9223372036854775807", "reserved": "True", "updated_at": "x"}'
    assert rows[1].excerpt == '{"sku": "b", "warehouse": "3", "quantity": "1E+3", "reserved": "4.0", "updated_at": null}'
    assert '"updated_at": "[tipo inválido]"' in rows[2].excerpt and '"warehouse": null' in rows[3].excerpt
    assert [r.excerpt.rsplit(" ", 1)[1] for r in rows[4:]] == ["int", "list", "bool", "NoneType", "str", "Decimal"]
    assert all(r.sku is None for r in rows[4:])


def test_filter_by_time(spark):
    frame = spark.createDataFrame([("2024-07-01T00:00:00Z",), ("soon",), ("2024-06-30T23:59:59Z",)], "updated_at string")
    assert stock_pages.changed_since(frame, "2024-07-01").count() == 1
    assert stock_pages.changed_since(frame, "whenever").count() == 3


def test_rules_of_several_documents(spark, tmp_path):
    """The order is that of the paths, not of the sizes; elements that a plan does not need are no strangers."""
    for name, label, count in (("c", "three", 1), ("a", "one", 2), ("b", "two", 40)):
        rules = "".join(
            f'<Descuento tipo="marca" valor="{label} {i}"><PorcentajeBase>{i}</PorcentajeBase><PorVolumen>v</PorVolumen></Descuento>' for i in range(count))
        (tmp_path / f"{name}.xml").write_text(f"<TarifasProveedor><Descuentos>{rules}</Descuentos><Excepciones/></TarifasProveedor>")
    rules = tariffs.scan_rules(tariffs.read_elements(spark, str(tmp_path)))
    assert [r.label for r in rules.orderBy("ord").collect()] == ["one 0", "one 1", *[f"two {i}" for i in range(40)], "three 0"]
    assert rules.select("other_children").distinct().collect()[0][0] == 0


def test_digest_of_many_files(spark, tmp_path):
    """Exchanged, renamed and moved bytes change it; the order of listing and the folder do not."""

    def digest(name, contents, fan_in=3):
        folder = tmp_path / name
        for path, content in contents.items():
            (folder / path).parent.mkdir(parents=True, exist_ok=True)
            (folder / path).write_bytes(content)
        rows = materialized(files.source_fingerprint(spark, str(folder)))
        root = files.source_root(rows)
        assert root.endswith(f"/{name}/")
        shuffled = files.source_digest(rows.orderBy(F.desc("sha256")).coalesce(1), root, fan_in).first().sha256
        assert shuffled == files.source_digest(rows.repartition(5), root, fan_in).first().sha256
        return shuffled

    base = {f"p{i:02d}.csv": b"row %d\n" % i for i in range(11)}
    first, last = "p00.csv", "p10.csv"
    found = [
        digest("base", base), digest("swapped", base | {first: base[last], last: base[first]}),
        digest("renamed", {("q" if name == last else "") + name: content for name, content in base.items()}),
        digest("moved", base | {first: base[first] + base[last][:1], last: base[last][1:]}),
        digest("fewer", {name: content for name, content in base.items() if name != last}),
    ]
    assert len(set(found)) == len(found) and digest("again", base) == found[0]
    assert digest("wide", base, fan_in=100) != found[0]


def test_fingerprint(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc")
    before = files.source_fingerprint(spark, str(tmp_path))
    assert [r.sha256 for r in before.collect()] == [hashlib.sha256(b"abc").hexdigest()]
    kept = spark.createDataFrame(before.collect(), before.schema)
    assert files.changed_files(kept, files.source_fingerprint(spark, str(tmp_path))).count() == 0
    assert files.source_digest(kept).first().sha256 == hashlib.sha256(b"abc").hexdigest()
    (tmp_path / "a").write_bytes(b"abd")
    assert files.changed_files(kept, files.source_fingerprint(spark, str(tmp_path))).count() == 1
    empty = tables.empty_source(kept.where("false"), "EMPTY_CATALOG")
    assert [r.problem for r in empty.collect()] == ["EMPTY_CATALOG"]
    assert tables.empty_source(kept, "EMPTY_CATALOG").count() == 0
