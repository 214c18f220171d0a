"""Tables in HTML pages, read with the standard parser."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Fixed limits: tables looked at and kept, rows kept, caption length.
SCANNED, KEPT, ROWS, CAPTION = 9, 3, 50, 80


class Reader(HTMLParser):
    """Collects each top-level table's caption and rows of cells."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self.depth, self.heading, self.text, self.into = 0, "", [], ""

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append({"caption": "", "before": self.heading, "rows": []})
        elif tag in ("h1", "h2", "h3", "h4") or (self.depth == 1 and tag == "caption"):
            self.text, self.into = [], tag
        elif self.depth == 1 and tag == "tr":
            self.finish()
            self.tables[-1]["rows"].append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self.finish()
            if not self.tables[-1]["rows"]:
                self.tables[-1]["rows"].append([])
            self.text, self.into = [], tag

    def finish(self):
        said = " ".join("".join(self.text).split())
        if self.into in ("td", "th") and self.depth:
            self.tables[-1]["rows"][-1].append(said)
        elif self.into == "caption" and self.depth:
            self.tables[-1]["caption"] = said
        elif self.into.startswith("h"):
            self.heading = said
        self.text, self.into = [], ""

    def handle_endtag(self, tag):
        if tag == self.into or (tag in ("tr", "table") and self.into in ("td", "th")):
            self.finish()
        if tag == "table":
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.into:
            self.text.append(data)


def tables(page: str | None, topic: str | None = None) -> list[dict]:
    """Up to KEPT tables: caption, header, rows as wide as it with any text. With a
    topic, its text or one of its longer words must be in the first five rows."""
    reader = Reader()
    reader.feed(page or "")
    reader.close()
    out = []
    for t in reader.tables[:SCANNED]:
        rows = [r for r in t["rows"] if r]
        if len(rows) < 2 or len(out) == KEPT:
            continue
        header, kept = rows[0], [r for r in rows[1 : ROWS + 1] if len(r) == len(rows[0]) and any(r)]
        if not kept:
            continue
        if topic:
            said = " ".join(" ".join(r) for r in [header, *kept[:5]]).lower()
            if topic.lower() not in said and not any(w in said for w in topic.lower().split() if len(w) > 3):
                continue
        out.append({"caption": (t["caption"] or t["before"])[:CAPTION], "header": header, "rows": kept})
    return out


def as_text(found: list[dict], most: int = 10) -> str:
    return "\n\n".join("\n".join([t["caption"], " | ".join(t["header"]), *(" | ".join(r) for r in t["rows"][:most])]) for t in found)


@F.udtf(returnType=StructType([StructField(n, IntegerType()) for n in ("table_no", "row_no")] + [StructField(n, StringType()) for n in ("caption", "header", "value")]))
class ExtractTables:
    """A row for each cell of each table in a page; usable in a lateral join."""

    def eval(self, page: str, topic: str):
        for k, t in enumerate(tables(page, topic)):
            for i, row in enumerate(t["rows"]):
                for name, cell in zip(t["header"], row, strict=True):
                    yield k, i, t["caption"], name, cell
