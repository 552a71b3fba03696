"""Keys, ids and codes built from text Columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digits of a business serial number; the last two are two characters long.
BSN_DIGITS = (
    "0 1 2 3 4 5 6 7 8 9 a b c d e f g h i j k l m n o p q r s t u v w x y z "
    "A B C D E F G H I J K L M N O P Q R S T U V W X Y Z a1 a2"
).split()


def meter_key(sn: Column, code: Column, type_: Column, addr: Column) -> Column:
    """``sn_code_type_add``; a missing part reads ``null`` rather than vanishing."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("null")) for c in (sn, code, type_, addr)])


def surrogate_id(kind: str, *natural_key: Column) -> Column:
    """32 hex characters, the same on every run and retry."""
    return F.md5(F.concat_ws("|", F.lit(kind), *natural_key))


def phase_id(feed_id: Column, time_text: Column) -> Column:
    return F.concat_ws("_", feed_id, time_text)


def usage_id(feed_id: Column, start_time: Column, end_time: Column) -> Column:
    return F.concat(feed_id, start_time.cast("string"), end_time.cast("string"))


def bsn_source(sn: Column, addr: Column, type_: Column) -> Column:
    return F.concat(sn, F.lit("a"), addr, F.lit("t"), type_)


def bsn_encode(text: Column) -> Column:
    """Hex digits of the UTF-8 bytes in threes, each three written as two base-64 digits, low one first."""
    digits = F.array(*[F.lit(d) for d in BSN_DIGITS])
    hexed = F.regexp_replace(F.hex(F.encode(text, "UTF-8")), "^0+(?=.)", "")

    def chunk(start):
        number = F.conv(F.substring(hexed, start, F.lit(3)), 16, 10).cast("int")
        low, high = F.pmod(number, F.lit(64)), F.floor(number / 64).cast("int")
        return F.concat(F.get(digits, low), F.get(digits, high))

    starts = F.sequence(F.lit(1), F.length(hexed), F.lit(3))
    return F.when(F.length(text) > 0, F.array_join(F.transform(starts, chunk), ""))
