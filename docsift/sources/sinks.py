"""Sinks: CSV, XLSX, the validation report, the event log and the archive of bodies."""

from __future__ import annotations

import os
import re
import shutil
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.functions import vocab
from docsift.functions.urls import archive_path
from docsift.session import ship


def output_rows(df: DataFrame) -> DataFrame:
    """The 22 columns as text, in order."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in vocab.COLUMNS])


def check_columns(df: DataFrame) -> None:
    extra = [c for c in df.columns if c not in vocab.COLUMNS]
    if extra:
        raise ValueError(f"not output columns: {', '.join(extra)}")


def write_csv_parts(df: DataFrame, folder: str) -> None:
    """UTF-8, CRLF, quotes where needed; as many part files as partitions, for large outputs."""
    check_columns(df)
    (output_rows(df).write.mode("overwrite").option("header", True).option("lineSep", "\r\n").option("quote", '"').option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder))


def write_csv(df: DataFrame, path: str, order: str | None = None) -> str:
    """One CSV file on a mounted path; the header is written even without rows."""
    keep = df if order is None else df.orderBy(order)
    folder = f"{path}.parts"
    check_columns(df.drop(order) if order else df)
    write_csv_parts(keep.select(*vocab.COLUMNS).coalesce(1), folder)
    part = next(n for n in sorted(os.listdir(folder)) if n.startswith("part-"))
    os.replace(os.path.join(folder, part), path)
    shutil.rmtree(folder)
    return path


def _column_name(k: int) -> str:
    name = ""
    while k >= 0:
        name, k = chr(65 + k % 26) + name, k // 26 - 1
    return name


_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_UNPRINTABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def write_xlsx(df: DataFrame, path: str, sheet: str = "policy_documents") -> str:
    """A workbook of text cells: bold header, first row frozen, autofilter, widths by content. Rows stream through the driver."""
    check_columns(df)
    widths = [len(c) for c in vocab.COLUMNS]
    cell = lambda r, k, v, style: f'<c r="{_column_name(k)}{r}" t="inlineStr" s="{style}"><is><t xml:space="preserve">{escape(_UNPRINTABLE.sub("", v))}</t></is></c>'
    rows = [f'<row r="1">{"".join(cell(1, k, c, 2) for k, c in enumerate(vocab.COLUMNS))}</row>']
    for r, row in enumerate(output_rows(df).toLocalIterator(), 2):
        rows.append(f'<row r="{r}">{"".join(cell(r, k, v[:32767], 1) for k, v in enumerate(row))}</row>')
        widths = [max(w, len(v)) for w, v in zip(widths, row)]
    last = f"{_column_name(len(vocab.COLUMNS) - 1)}{len(rows)}"
    cols = "".join(f'<col min="{k}" max="{k}" width="{min(60, max(10, w + 2))}" customWidth="1"/>' for k, w in enumerate(widths, 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kinds}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="2"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf numFmtId="49" applyNumberFormat="1"/><xf fontId="1" numFmtId="49" applyFont="1" applyNumberFormat="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{cols}</cols><sheetData>{"".join(rows)}</sheetData><autoFilter ref="A1:{last}"/></worksheet>',
    }
    temporary = f"{path}.tmp"
    with zipfile.ZipFile(temporary, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in parts.items():
            archive.writestr(name, _XML + body)
    os.replace(temporary, path)
    return path


def write_output(df: DataFrame, folder: str, kind: str = "csv", also_xlsx: bool = False) -> list[str]:
    """CSV, XLSX or both; a workbook that can't be written leaves the CSV."""
    out = [] if kind == "xlsx" else [write_csv(df, os.path.join(folder, "output.csv"))]
    if kind == "xlsx" or also_xlsx:
        try:
            out.append(write_xlsx(df, os.path.join(folder, "output.xlsx")))
        except OSError:
            if not out:
                out.append(write_csv(df, os.path.join(folder, "output.csv")))
    return out


def validation_report(validated: DataFrame) -> DataFrame:
    """Text lines (seq, value): a URL and its problems, indented, for rows that have any."""
    bad = validated.where(F.size("problems") > 0)
    lines = F.concat_ws("\n", F.col("document_url"), F.array_join(F.transform("problems", lambda p: F.concat(F.lit("    - "), p)), "\n"))
    return bad.select(F.col("document_url").alias("seq"), lines.alias("value"))


def event_lines(events: DataFrame, run_id: str, fields: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines of an event log: ts, lvl, event, the fields that are not null, run_id last."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return events.select(F.to_json(F.struct(stamp.alias("ts"), "lvl", "event", *fields, F.lit(run_id).alias("run_id"))).alias("value"))


def archive(documents: DataFrame, root: str) -> DataFrame:
    """Write bodies under root (a folder that all executors mount) unless a file of that name and size is there; rows (path, written). Never fails a row."""
    ship(documents.sparkSession)
    path = archive_path(F.col("payer_name"), F.col("url"), F.col("digest"), F.col("file_type"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target, done = os.path.join(root, name), False
                try:
                    if not (os.path.exists(target) and os.path.getsize(target) == len(body or b"")):
                        os.makedirs(os.path.dirname(target), exist_ok=True)
                        with open(f"{target}.{os.getpid()}", "wb") as f:
                            f.write(body or b"")
                        os.replace(f.name, target)
                        done = True
                except OSError:
                    done = False
                out.append(done)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.bool_())], names=["path", "written"])

    return documents.select(path.alias("path"), F.col("content")).mapInArrow(run, "path string, written boolean")
