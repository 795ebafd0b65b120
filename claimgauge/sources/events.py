"""Run events: reading them and decoding their JSON envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.functions.variants import FALSY_JSON, get, is_object, once
from claimgauge.schemas import RAW_EVENT

DECODED, UNDECODABLE, BROKEN = "decoded", "undecodable", "broken"


def read_events(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Raw events (``event_id``, ``raw``) of a folder, for a backfill."""
    return spark.read.schema(RAW_EVENT).format(file_format).load(path)


def stream_events(spark: SparkSession, path: str, file_format: str = "json",
                  files_per_batch: int = 1000) -> DataFrame:
    """The same as a stream; any streaming source with these columns does as well."""
    return (spark.readStream.schema(RAW_EVENT).format(file_format)
            .option("maxFilesPerTrigger", files_per_batch).load(path))


def unique_events(events: DataFrame) -> DataFrame:
    """One row per ``event_id``, for a backfill that may hold an event twice."""
    return events.dropDuplicates(["event_id"])


def _base64_text(data: Column) -> Column:
    """Decoded UTF-8 text; NULL for wrong padding or invalid UTF-8.

    As lenient as common decoders: characters outside the alphabet are skipped, padding
    that nothing needs is ignored, and whatever follows the padding that ends the data is
    not read.
    """
    def mended(clean: Column) -> Column:
        def padded(letters: Column) -> Column:
            extra = F.length(letters) % 4
            ends = ((extra == 2) & clean.rlike("^[A-Za-z0-9+/]*==")) | (
                (extra == 3) & clean.rlike("^[A-Za-z0-9+/]*="))
            return F.when(ends, F.concat(letters, F.when(extra == 2, "==").otherwise("="))).otherwise(
                F.replace(clean, F.lit("="), F.lit("")))

        return once(F.regexp_extract(clean, "^[A-Za-z0-9+/]*", 0), padded)

    def read(text: Column, otherwise: Column) -> Column:
        plain = (F.length(text) % 4 == 0) & text.rlike(r"^[A-Za-z0-9+/]*={0,2}\z")
        return F.when(plain, F.try_to_binary(text, F.lit("base64"))).otherwise(otherwise)

    def cleaned(text: Column) -> Column:
        # whole stretches at a time: a search for single characters is tens of times slower
        known = F.regexp_replace(text, r"\G([A-Za-z0-9+/=]*+)[^A-Za-z0-9+/=]+", "$1")
        clean = F.ltrim(F.when(text.rlike(r"^[A-Za-z0-9+/=]*\z"), text).otherwise(known), F.lit("="))
        return once(once(clean, mended), lambda m: F.when(
            F.length(m) % 4 == 0, F.try_to_binary(m, F.lit("base64"))))

    # most texts are clean, most others only broken into lines; patterns over the whole
    # text are for the rest
    in_one = F.translate(data, " \t\r\n", "")
    binary = read(data, once(in_one, lambda text: read(text, cleaned(text))))
    return F.try_validate_utf8(binary.cast("string"))


def _judged(envelope: Column) -> Column:
    """``decoding``, ``doc`` and ``doc_is_object`` of a parsed envelope. Whatever is parsed or read
    from it is so once."""
    def of_parts(p: Column) -> Column:
        is_text = p["kind"] == "STRING"
        has_data = p["data"].isNotNull() & F.when(is_text, p["text"] != "").otherwise(
            ~F.to_json(p["data"]).isin(FALSY_JSON))
        wrong_shape = ~is_object(envelope) | (
            p["message"].isNotNull() & ~is_object(p["message"])) | (has_data & ~is_text)
        direct = (get(envelope, "$.payload").isNotNull()
                  & get(envelope, "$.source_timestamp").isNotNull())

        def of_inner(inner: Column) -> Column:
            readable = inner.isNotNull() & ~F.is_variant_null(inner)
            decoding = (
                F.when(envelope.isNull(), UNDECODABLE)
                .when(wrong_shape, BROKEN)
                .when(has_data, F.when(readable, DECODED).otherwise(UNDECODABLE))
                .when(direct, DECODED).otherwise(UNDECODABLE))
            return F.struct(
                decoding.alias("decoding"), F.when(has_data, inner).otherwise(envelope).alias("doc"),
                F.when(has_data, is_object(inner)).otherwise(True).alias("doc_is_object"))

        return once(F.when(has_data & is_text, F.try_parse_json(_base64_text(p["text"]))), of_inner)

    data = get(envelope, "$.message.data")
    return once(F.struct(
        get(envelope, "$.message").alias("message"), data.alias("data"),
        F.schema_of_variant(data).alias("kind"),
        F.try_variant_get(envelope, "$.message.data", "string").alias("text")), of_parts)


def decode_events(events: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``doc`` (the event as VARIANT) and ``decoding`` to raw events.

    The event is base64 JSON under ``message.data``, or else the document itself if it
    has both ``payload`` and ``source_timestamp``. ``decoding`` is ``decoded``,
    ``undecodable`` (for a quarantine) or ``broken``: an envelope of the wrong shape,
    such as a null ``message``, which fails rather than being refused. Of repeated keys the
    last counts, if ``spark.sql.variant.allowDuplicateKeys`` is set as in
    ``session.SETTINGS``; ``NaN`` and ``Infinity`` are no JSON here.
    """
    # a generator: later filters on the result stay above it instead of being pushed
    # down, which would parse the documents once more per use
    result = once(F.try_parse_json(F.col(raw)), _judged)
    decoded = events.select(*events.columns, F.inline(F.array(result)))
    return decoded.withColumn("doc", F.when(F.col("decoding") == DECODED, F.col("doc")))


def quarantined(decoded: DataFrame) -> DataFrame:
    """Events that could not be decoded, with their raw text."""
    return decoded.where(F.col("decoding") != DECODED).drop("doc", "doc_is_object")
