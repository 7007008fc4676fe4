"""Language identification by compression.

Each language has a zstandard dictionary of raw training text, in lower case like the texts that are judged. A
text is cut into blocks; every block is
compressed with each dictionary, and the language whose dictionaries give the fewest bytes in total wins. If
its lead over the next one is narrow, the decision is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.rows import byte_column, small_batches
from lonja.llm.words import lowered
from lonja.session import materialized

#: Bytes of raw text in the dictionary of one language and in all of them, and characters taken from one document.
DICTIONARY = 96 << 10
DICTIONARIES = 48 << 20
EXCERPT = 1 << 10
BLOCK = 1 << 10
LEVEL = 6
#: Narrowest lead, as a share of the winner's bytes, that is accepted.
MARGIN = 0.01
UNKNOWN = "und"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionary of each language, the most frequent one first, from labelled rows.

    The sample is bounded by ``DICTIONARY`` bytes a language and ``DICTIONARIES`` bytes in all, shared evenly if
    there are many languages; none is left out. It is filled in the order of a hash of the id with excerpts of at
    most ``EXCERPT`` characters from hash-chosen places of the texts. Rows without a language, a text or a letter
    in it teach nothing; a null id takes part; an empty table gives no dictionary.
    """
    turn = F.xxhash64(F.col(doc_id).cast("string"), F.lit(5))
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), turn.alias("turn"), F.lower(F.col(text)).alias("text"))
    place = F.pmod(F.xxhash64("turn", F.length("text")), F.greatest(F.length("text") - EXCERPT + 1, F.lit(1))) + 1
    rows = rows.select("lang", "turn", F.substring("text", place.cast("int"), F.lit(EXCERPT)).alias("text")).withColumn(
        "bytes", F.octet_length("text").cast("long") + 1)
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("all_bytes"))
    known = materialized(known, "languages")  # a row a language
    found = {row.lang: [] for row in known.orderBy(F.desc("rows"), "lang").select("lang").collect()}
    size = min(DICTIONARY, DICTIONARIES // max(1, len(found)))
    # A hash keeps about four dictionaries of each language; they are few enough for one window.
    share = F.pmod(F.xxhash64("turn", F.lit(6)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = rows.join(known.select("lang", "all_bytes"), "lang").where(share * F.col("all_bytes") < 4 * size)
    before = Window.partitionBy("lang").orderBy("turn", "text").rowsBetween(Window.unboundedPreceding, -1)
    few = few.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0))).where(F.col("before") < size)
    for row in few.select("lang", "before", "text").orderBy("lang", F.desc("before")).toLocalIterator():
        found[row.lang].append(row.text.encode())
    # The end of a dictionary is cheapest to refer to, so its bytes are kept.
    return {name: b"\n".join(parts)[-size:] for name, parts in found.items()}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", block: int = BLOCK, level: int = LEVEL,
             margin: float = MARGIN) -> DataFrame:
    """All columns of the rows and ``lang_best, lang_score, lang_rejected``.

    ``lang_score`` is the winner's softmax over bytes saved per 100 bytes of text, from 0 to 1. A null text or
    one without a letter has language ``und``, score 0 and is rejected, and so is every text if no language is
    known. Ties go to the language that comes first, the most frequent one after ``train``.
    """
    small_batches(docs.sparkSession)
    names = list(dictionaries)
    place = docs.columns.index(text)
    kept = docs.columns
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    columns = [*kept, "lang_best", "lang_score", "lang_rejected"]
    spoken_name = "_spoken"
    while spoken_name in kept:
        spoken_name += "_"
    # Bounded by DICTIONARIES; the work on a text grows with the number of languages.
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coders = []
        for name in names:
            content = zstandard.ZstdCompressionDict(shared.value[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            coders.append(zstandard.ZstdCompressor(
                level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        for batch in batches:
            data, at = byte_column(lowered(batch.column(place)))
            data = data.tobytes()
            spoken = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            best, score, rejected = [], np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            for row in range(batch.num_rows):
                if not spoken[row] or not coders:
                    best.append(UNKNOWN)
                    continue
                begin, end = int(at[row]), int(at[row + 1])
                sizes = np.zeros(len(coders))
                for start in range(begin, end, block):
                    part = data[start : min(start + block, end)]
                    sizes += [len(code(part)) for code in coders]
                first = int(np.argmin(sizes))
                best.append(names[first])
                gain = 100 * (sizes - sizes[first]) / (end - begin)
                score[row] = 1 / np.exp(-gain).sum()
                lead = np.partition(sizes, 1)[1] - sizes[first] if len(sizes) > 1 else sizes[first]
                rejected[row] = lead < margin * sizes[first]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(best, pa.string()), pa.array(score), pa.array(rejected)], columns)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.withColumn(spoken_name, letters).mapInArrow(
        run, f"{fields}, lang_best string, lang_score double, lang_rejected boolean")
