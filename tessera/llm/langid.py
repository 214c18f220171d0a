"""Language by compression: the dictionary that packs a text best names its language.

Fitting takes, per language, the SAMPLE_DOCS labelled texts of smallest hash and
makes a raw-content zstandard dictionary of at most DICTIONARY_BYTES from all of
them (equal texts once). A text is reduced to lower-case letters and single spaces,
cut into blocks of BLOCK_BYTES so that a long text can't serve as its own
dictionary, and every block is compressed with every dictionary. The smallest
total names the language; ties go to the language that sorts first.
``score`` is the softmax share of the winner over sizes in bits, and a text is
``rejected`` if it has no letter or if the runner-up needs less than MARGIN more.

Null texts and texts without a letter are ``und`` with score 0. Labels that are
null, and null or letterless texts, don't take part in fitting; rows that repeat
an id count by their texts, once each. With no labelled rows at all, every text
is ``und``. Repeated rows are treated row by row, texts whole however long; an
empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import collect_bounded, filter_batches, held, map_batches

SAMPLE_DOCS = 128
#: Bound on a language's dictionary, well above SAMPLE_DOCS usual texts.
DICTIONARY_BYTES = 512 << 10
MAX_LANGUAGES = 256
BLOCK_BYTES = 4096
LEVEL = 5
#: Share of its size by which the runner-up must be larger.
MARGIN = 0.004
#: Within this share, texts are measured once more at several levels.
FINE_MARGIN, FINE_LEVELS = 0.05, (1, 3, 8, 12)
UNKNOWN = "und"

NOT_LETTERS = re.compile(r"[\W\d_]+")


def reduced(text: str) -> str:
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def training(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that a model may learn from; the others are held out."""
    return df.filter(~held_out(F.col(id_col)))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, bytes]:
    """Dictionary contents by language. Ids are ranked before texts are read;
    row_number() <= n is cut down in every task before rows are exchanged."""
    usable = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    usable = usable.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text")
    each = usable.select("id", "lang", F.xxhash64("text").alias("text"))
    rows = each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_DOCS)
    picked = collect_bounded(rows, SAMPLE_DOCS * MAX_LANGUAGES, "language sample")
    if not picked:
        return {}
    ids = sorted({r.id for r in picked}, key=str)
    wanted = usable.filter(F.col("id").isin(ids)).select("id", "lang", F.xxhash64("text").alias("digest"), F.substring("text", 1, DICTIONARY_BYTES).alias("text"))
    wanted = wanted.groupBy("id", "lang", "digest").agg(F.min("text").alias("text"))
    chosen = {(r.id, r.lang, r.text) for r in picked}
    texts: dict[str, dict[bytes, tuple]] = {}
    for r in wanted.toLocalIterator():
        if (r.id, r.lang, r.digest) in chosen and (t := reduced(r.text)):
            texts.setdefault(r.lang, {}).setdefault(t.encode(), (str(r.id), r.digest))
    return {lang: content([t for t, _ in sorted(found.items(), key=lambda x: (x[1], x[0]))]) for lang, found in sorted(texts.items())}


def content(texts: list[bytes]) -> bytes:
    """All texts in one dictionary of at most DICTIONARY_BYTES. If they are more,
    the longest are shortened, at spaces, to one common length; none is left out."""
    room, most = DICTIONARY_BYTES - len(texts), DICTIONARY_BYTES
    sizes = sorted(map(len, texts))
    if sum(sizes) > room:
        for k, size in enumerate(sizes):
            if size * (len(sizes) - k) > room:
                most = max(1, room // (len(sizes) - k))
                break
            room -= size
    return b" ".join(t if len(t) <= most else t[: most + 1].rpartition(b" ")[0] or t[:most].decode(errors="ignore").encode() for t in texts)


class Classifier:
    def __init__(self, contents: dict[str, bytes]):
        self.names = sorted(contents)
        self.contents = contents
        self.packers = self.at(LEVEL)
        self.finer: list[list] = []

    def at(self, level: int) -> list:
        out = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(self.contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False).compress)
        return out

    def finely(self, data: bytes) -> list[float]:
        """Mean sizes over FINE_LEVELS, of the text and of its distinct
        words: whole bytes tell short and repetitive texts apart too coarsely."""
        if not self.finer:
            self.finer = [self.at(level) for level in FINE_LEVELS]
        once = b" ".join(dict.fromkeys(data.split()))
        parts = [x[i : i + BLOCK_BYTES] for x in {data, once} for i in range(0, len(x), BLOCK_BYTES)]
        return [sum(len(packers[i](x)) for packers in self.finer for x in parts) / len(FINE_LEVELS) for i in range(len(self.names))]

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        data = reduced(text or "").encode()
        if not data or not self.names:
            return UNKNOWN, 0.0, True
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum(len(pack(b)) for b in blocks) for pack in self.packers]
        if len(sizes) > 1 and sorted(sizes)[1] - min(sizes) < FINE_MARGIN * min(sizes):
            sizes = self.finely(data)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        low = sizes[best]
        score = 1 / sum(math.exp(-8 * math.log(2) * min(60, s - low)) for s in sizes)
        second = min((s for i, s in enumerate(sizes) if i != best), default=math.inf)
        return self.names[best], score, second - low < MARGIN * low


def classifier(model) -> Classifier:
    return held("langid", model.id, lambda: Classifier(model.value))


class Model:
    """The broadcast dictionaries (at most MAX_LANGUAGES * DICTIONARY_BYTES) and
    a number that workers know them by."""

    def __init__(self, spark, contents: dict[str, bytes]):
        self.shared = spark.sparkContext.broadcast(contents)
        self.id = hashlib.sha256(repr(sorted(contents.items())).encode()).hexdigest()

    @property
    def value(self):
        return self.shared.value


def predict(df: DataFrame, contents: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row."""
    model = Model(df.sparkSession, contents)

    def work(rows):
        c = classifier(model)
        got = [c.classify(t) for t in rows["text"]]
        return {"id": rows["id"], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "rejected": [g[2] for g in got]}

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return map_batches(picked, work, f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def keep_known(df: DataFrame, contents: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose language is told with a sufficient margin."""
    model = Model(df.sparkSession, contents)

    def keep(texts):
        c = classifier(model)
        return [not c.classify(t)[2] for t in texts]

    return filter_batches(df, text_col, keep)
