"""Sinks: ordered single-file CSV, sheets as folders, and a workbook written with the standard library."""

from __future__ import annotations

import os
import shutil
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHEET_ROWS = 1_048_576
#: CSV with a header and every value as it is, outer blanks included.
AS_WRITTEN = {"header": True, "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_ordered(df: DataFrame, path: str, order: list[str], columns: list[str] | None = None) -> None:
    """One CSV file in a fixed order, equal on every run. For deliveries of one season; large tables are written as they are partitioned."""
    df.orderBy(*order).select(*(columns or [c for c in df.columns if not c.startswith("_")])).coalesce(1).write.mode("overwrite").options(**AS_WRITTEN).csv(path)


def write_map(entries: DataFrame, path: str) -> None:
    flat = entries.withColumn("variants", F.array_join("variants", " | "))
    write_ordered(flat, path, ["stats_team", "stats_name"])


def write_schedule(rows: DataFrame, folder: str, season: str) -> Path:
    """A season's schedule as one file, whole or not at all; an older one is replaced."""
    at = Path(folder)
    at.mkdir(parents=True, exist_ok=True)
    staged = at / f".schedule_{season}"
    rows.orderBy("gamecode").coalesce(1).write.mode("overwrite").options(**AS_WRITTEN).csv(f"file://{staged}")
    out = at / f"schedule_{season}.csv"
    os.replace(next(staged.glob("part-*.csv")), out)
    shutil.rmtree(staged)
    return out


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """A parquet folder per sheet: no limit on rows."""
    for name, df in sheets.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def numbered(folder: str, stem: str, round_: int) -> str:
    return f"{folder}/{stem}_{round_:03d}"


def _letters(n: int) -> str:
    out = ""
    while n >= 0:
        n, r = divmod(n, 26)
        out, n = chr(65 + r) + out, n - 1
    return out


def _cell(ref: str, v: object) -> str:
    if v is None:
        return ""
    if isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and abs(v) != float("inf"):
        return f'<c r="{ref}"><v>{v}</v></c>'
    text = ", ".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def write_workbook(sheets: dict[str, DataFrame], path: str) -> None:
    """A workbook with a sheet per frame, rows streamed from Spark; a sheet beyond the format's row limit is an error."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kinds, links, names = [], [], []
        for k, (name, df) in enumerate(sheets.items(), 1):
            kinds.append(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
            links.append(f'<Relationship Id="rId{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>')
            names.append(f'<sheet name="{escape(name[:31])}" sheetId="{k}" r:id="rId{k}"/>')
            with z.open(f"xl/worksheets/sheet{k}.xml", "w") as out:
                out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{main}"><sheetData>'.encode())
                out.write(f'<row r="1">{"".join(_cell(f"{_letters(i)}1", c) for i, c in enumerate(df.columns))}</row>'.encode())
                for n, row in enumerate(df.toLocalIterator(), 2):
                    if n > SHEET_ROWS:
                        raise ValueError(f"sheet {name} has more than {SHEET_ROWS} rows; write it as a folder")
                    out.write(f'<row r="{n}">{"".join(_cell(f"{_letters(i)}{n}", v) for i, v in enumerate(row))}</row>'.encode())
                out.write(b"</sheetData></worksheet>")
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{"".join(names)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}/relationships">{"".join(links)}</Relationships>')
        z.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{"".join(kinds)}</Types>')
