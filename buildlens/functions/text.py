"""String functions: hash keys, transliteration, report-safe text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin for Cyrillic letters.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o",
    "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}


def hash_key(h: Column) -> Column:
    """Low 64 bits of a hex hash as 16 lower-case digits; null if it isn't hex."""
    t = F.trim(h)
    return F.when(t.rlike("^[0-9A-Fa-f]+$"), F.lpad(F.lower(F.right(t, F.lit(16))), 16, "0"))


def packed(s: Column) -> Column:
    """The text as bytes that no other text has: pairs of lower-case hex digits as a byte each after an ``x``, anything else as it is after a ``t``."""
    hex_pairs = s.rlike(r"^[0-9a-f]+\z") & (F.length(s) % 2 == 0)
    return F.when(hex_pairs, F.concat(F.lit(bytearray(b"x")), F.unhex(s))).otherwise(F.concat(F.lit(bytearray(b"t")), s.cast("binary")))


def transliterate(s: Column) -> Column:
    """Upper-case file name of A-Z, digits, dot, hyphen and single underscores."""
    one = {k: v for k, v in LATIN.items() if len(v) == 1}
    t = F.translate(F.lower(s), "".join(one), "".join(one.values()))
    for k, v in LATIN.items():
        if len(v) != 1:
            t = F.replace(t, F.lit(k), F.lit(v))
    t = F.regexp_replace(F.replace(F.upper(t), F.lit(" "), F.lit("_")), "[^A-Z0-9_.-]", "")
    return F.regexp_replace(F.regexp_replace(t, "_+", "_"), "^_|_$", "")


def report_text(s: Column, most: int = 32767) -> Column:
    """Text without control characters that XML forbids, cut to a cell's length."""
    t = F.regexp_replace(s, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    return F.when(F.length(t) > most, F.concat(F.left(t, F.lit(most - 3)), F.lit("..."))).otherwise(t)


def shown_command(argv: Column, most: int = 6) -> Column:
    """The first words of a command, with dots where there are more; empty without any."""
    return F.concat(F.array_join(F.slice(argv, 1, most), " "), F.when(F.size(argv) > most, " ...").otherwise(""))


def clock(seconds: Column) -> Column:
    """Whole seconds as hours, minutes and seconds: 01:02:03."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.expr("0L") + F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def short_duration(nanoseconds: Column) -> Column:
    """12ms below a second, 1.23s below a minute (cut, not rounded), else 2m05s."""
    ms = F.floor(nanoseconds / 1_000_000).cast("long")
    seconds = F.concat(F.when(ms >= 1000, F.floor(ms / 1000).cast("string")).otherwise(""), F.lit("."), F.lpad(F.floor(ms % 1000 / 10).cast("string"), 2, "0"), F.lit("s"))
    whole = F.floor(ms / 1000).cast("long")
    minutes = F.format_string("%dm%02ds", F.floor(whole / 60), whole % 60)
    return F.when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms"))).when(ms < 60_000, seconds).otherwise(minutes)


def project_key(name: Column, suffix: Column) -> Column:
    """Key of a project on a server: letters, digits and -_.: stay, others become _, 95 characters and the given suffix."""
    safe = F.regexp_replace(name, r"[^\p{L}\p{N}\-_.:]", "_")
    return F.concat(F.left(F.regexp_replace(safe, "^_+|_+$", ""), F.lit(95)), F.lit("_"), suffix)


def snapshot_name(name: Column, suffix: str) -> Column:
    return F.concat(name, F.lit(suffix))


def json_escaped(s: Column) -> Column:
    """A string as it stands in JSON, without the quotes around it."""
    quoted = F.to_json(F.struct(F.coalesce(s, F.lit("")).alias("s")))
    return F.substring(quoted, 7, F.length(quoted) - 8)


# Encodings that names may have been written in, in the order they are tried.
ENCODINGS = ("cp1251", "koi8-r", "cp866", "iso8859-5")


def repaired_name(data: bytes | None) -> str | None:
    """A name from its bytes: UTF-8, else the first encoding that gives the same bytes back, else with bad bytes replaced."""
    if data is None:
        return None
    for encoding in ("utf-8", *ENCODINGS):
        try:
            name = data.decode(encoding)
            if name.encode(encoding) == data:
                return name
        except UnicodeError:
            continue
    return data.decode(errors="replace")


def repaired(data: Column) -> Column:
    """``repaired_name`` of a binary column. Spark's own decoding knows none of the encodings, so batches go through Python."""

    @F.pandas_udf("string")
    def names(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda b: repaired_name(None if b is None else bytes(b)))

    return names(data)
