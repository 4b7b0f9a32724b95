"""Language of whole texts by compression with one dictionary per language."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICTIONARY_BYTES = 16 << 10
TRAINING_CHARS = 8 << 10
BLOCK_BYTES = 8 << 10
#: Matches of 4 bytes count, found by a lazy search in a window that holds dictionary and block.
SEARCH = dict(window_log=16, hash_log=14, chain_log=14, search_log=3, min_match=4)
LEAST_MARGIN = 0.005
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def letters(text: Column) -> Column:
    """Lower case, with every run of characters that are no letters as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def learn_dictionaries(docs: DataFrame, most: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw dictionary content per language, from a bounded sample of labelled documents.

    Documents with a language whose id is not held out are drawn by a hash of the id, at a rate per
    language that gives about four times ``most`` bytes; at most ``TRAINING_CHARS`` of one document are
    used, in the order of the hash, until ``most`` bytes are reached. So what reaches the driver is
    bounded per language, however many documents there are. The language with most text comes first.
    """
    text = letters(F.substring("text", 1, TRAINING_CHARS))
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.filter(~held_out(F.col("doc_id"))).select("lang", F.xxhash64("doc_id").alias("turn"), text.alias("text"))
    # A language without letters in any document has nothing to learn, and no rate could bound its sample.
    totals = usable.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).filter("bytes > 0")
    coin = F.pmod("turn", F.lit(1 << 32)) / float(1 << 32)
    drawn = usable.join(F.broadcast(totals), "lang").filter(coin * F.col("bytes") < 4 * most)
    sample: dict[str, list[bytes]] = {}
    for lang, _, line in sorted((r["lang"], r["turn"], r["text"]) for r in drawn.collect()):
        parts = sample.setdefault(lang, [])
        if sum(map(len, parts)) < most:
            parts.append(line.encode())
    known = {lang: b" ".join(parts)[:most] for lang, parts in sample.items() if any(parts)}
    size = {r["lang"]: r["bytes"] for r in totals.filter(F.col("lang").isin(list(known))).collect()}
    return {lang: known[lang] for lang in sorted(known, key=lambda name: (-size[name], name))}


class Compressors:
    """One compressor per language; the best code is the shortest."""

    def __init__(self, dictionaries: Mapping[str, bytes]):
        import zstandard as zstd

        self.names = list(dictionaries)
        search = zstd.ZstdCompressionParameters(
            strategy=zstd.STRATEGY_LAZY, write_content_size=False, write_dict_id=False, **SEARCH
        )
        self.each = []
        for content in dictionaries.values():
            known = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=search)
            self.each.append(zstd.ZstdCompressor(dict_data=known, compression_params=search))

    def sizes(self, text: bytes) -> list[int]:
        """Bytes of all blocks of the text per language. Blocks are coded apart, so that the dictionary
        counts in a long text as it does in a short one."""
        blocks = [text[k : k + BLOCK_BYTES] for k in range(0, len(text), BLOCK_BYTES)]
        return [sum(len(c.compress(block)) for block in blocks) for c in self.each]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        if not text or not self.names:
            return UNDETERMINED, 0.0, 0.0
        ranked = sorted((size, k) for k, size in enumerate(self.sizes(text.encode())))
        if len(ranked) == 1:
            return self.names[0], 1.0, 1.0
        best, second = ranked[0][0], ranked[1][0]
        return self.names[ranked[0][1]], second / (best + second), (second - best) / second


def with_language(
    docs: DataFrame, dictionaries: Mapping[str, bytes], least_margin: float = LEAST_MARGIN, output: str = "_language"
) -> DataFrame:
    """``docs`` with a struct: lang_pred, score, margin and accepted. Only the text is looked at."""

    @F.arrow_udf("lang_pred string, score double, margin double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compressors = Compressors(dictionaries)
        for batch in batches:
            names, scores, margins = [], [], []
            for text in batch:
                name, score, margin = compressors.predict(text.as_py())
                names.append(name)
                scores.append(score)
                margins.append(margin)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())],
                ["lang_pred", "score", "margin"],
            )

    p = F.col(output)
    accepted = (p["lang_pred"] != UNDETERMINED) & (p["margin"] >= least_margin)
    return docs.withColumn(output, predict(letters(F.col("text")))).withColumn(output, p.withField("accepted", accepted))


def identify_languages(docs: DataFrame, least_margin: float = LEAST_MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin and accepted for every row of ``docs``.

    The letters of the text, in lower case, are coded with every language's dictionary; the shortest code
    names the language, ties go to the language with most text to learn from. ``score`` is second / (best + second) of the two
    shortest codes, ``margin`` their relative difference; a text whose margin is below ``least_margin``
    is not accepted. A null text or one without a letter is ``und`` with score 0, and so is every text
    when nothing could be learned. A null doc_id is held out as null. Equal texts get equal predictions;
    an empty table gives no rows; other columns are not read.
    """
    named = with_language(docs.select("doc_id", "text"), learn_dictionaries(docs), least_margin)
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_language.*")
