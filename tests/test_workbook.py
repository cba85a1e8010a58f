"""S3 parser details: first sheet by workbook order, cell kinds, blanks (Q14)."""

import datetime as dt
import zipfile

from cardlake.schemas import struct_type
from cardlake.sources.workbook import parse_first_sheet, read_workbooks

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _book(path, first_sheet_xml, other_sheet_xml):
    """Two sheets; the first in workbook order is stored as sheet2.xml."""
    wb = (f'<workbook xmlns="{NS}" xmlns:r="{R}"><sheets>'
          '<sheet name="Data" sheetId="2" r:id="rId7"/>'
          '<sheet name="Old" sheetId="1" r:id="rId1"/></sheets></workbook>')
    rels = ('<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId1" Type="{R}/worksheet" Target="worksheets/sheet1.xml"/>'
            f'<Relationship Id="rId7" Type="{R}/worksheet" Target="/xl/worksheets/sheet2.xml"/>'
            "</Relationships>")
    sst = f'<sst xmlns="{NS}"><si><t>passport</t></si><si><r><t>P</t></r><r><t>7</t></r></si><si><t></t></si></sst>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/sharedStrings.xml", sst)
        z.writestr("xl/worksheets/sheet2.xml", first_sheet_xml)
        z.writestr("xl/worksheets/sheet1.xml", other_sheet_xml)


SERIAL = (dt.date(2021, 3, 5) - dt.date(1899, 12, 30)).days
HEADER = ('<row r="1"><c r="A1" t="inlineStr"><is><t>date</t></is></c>'
          '<c r="B1" t="s"><v>0</v></c></row>')
BODY = (f'<row r="2"><c r="A2"><v>{SERIAL}</v></c><c r="B2" t="s"><v>1</v></c></row>'
        '<row r="3"><c r="A3" t="str"><v>2021-03-06</v></c>'
        '<c r="B3" t="inlineStr"><is><t>P8</t></is></c></row>'
        '<row r="4"><c r="B4" t="s"><v>2</v></c></row>'
        '<row r="5"></row>')
OTHER = f'<worksheet xmlns="{NS}"><sheetData><row r="1"><c r="A1"><v>99</v></c></row></sheetData></worksheet>'


def _sheet(extra=""):
    return f'<worksheet xmlns="{NS}"><sheetData>{HEADER}{BODY}{extra}</sheetData></worksheet>'


def test_parser_reads_first_sheet_and_cell_kinds(tmp_path):
    path = tmp_path / "book.xlsx"
    _book(path, _sheet('<row r="6"><c r="A6" t="b"><v>1</v></c><c r="C6"><v>3.5</v></c></row>'),
          OTHER)
    rows = parse_first_sheet(path.read_bytes())
    assert rows[0] == ["date", "passport"]            # sheet 'Data' (sheet2.xml), not sheet1.xml
    assert rows[1] == [str(SERIAL), "P7"]             # shared rich text joined
    assert rows[2] == ["2021-03-06", "P8"]            # formula string, inline string
    assert rows[3] == [None, None]                    # empty shared string is a blank
    assert rows[4] == []                              # empty row
    assert rows[5] == ["true", None, "3.5"]           # boolean, gap, number


def test_typed_read_dates_and_blanks(spark, tmp_path):
    path = tmp_path / "passport_blacklist_05032021.xlsx"
    _book(path, _sheet(), OTHER)
    got = read_workbooks(spark, str(path), struct_type("stg_blacklist")).collect()
    # the all-blank rows are skipped; a serial and ISO text both become dates
    assert sorted(((r.date, r.passport) for r in got), key=repr) == [
        (dt.date(2021, 3, 5), "P7"), (dt.date(2021, 3, 6), "P8")]
    assert all(r.file_name == path.name for r in got)
