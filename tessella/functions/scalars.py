"""Column functions on ids, times, languages, hosts, errors and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EARLIEST, FUTURE_HOURS

#: Fixed value: digits of a timestamp id, in order.
TID_DIGITS = "234567abcdefghijklmnopqrstuvwxyz"


def tid_micros(rkey: Column) -> Column:
    """Microseconds of a timestamp id; null if it is none. Thirteen base-32 digits, the last ten bits are a clock id."""
    digits = F.split(F.substring(rkey, 1, 13), "")
    digits = F.filter(digits, lambda c: c != "")
    value = F.aggregate(digits, F.lit(0).cast("long"), lambda acc, c: F.shiftleft(acc, 5).bitwiseOR((F.instr(F.lit(TID_DIGITS), c) - 1).cast("long")))
    return F.when(rkey.rlike("^[2-7a-j][2-7a-z]{12}$"), F.shiftrightunsigned(value, 10))


def tid_of(micros: Column, clock: int = 0) -> Column:
    """The timestamp id of a time."""
    value = F.shiftleft(micros, 10).bitwiseOR(F.lit(clock).cast("long"))
    digit = lambda k: F.substring(F.lit(TID_DIGITS), (F.shiftrightunsigned(value, 5 * k).bitwiseAND(F.lit(31).cast("long")) + 1).cast("int"), F.lit(1))
    return F.concat(*[digit(k) for k in range(12, -1, -1)])


def micros_ntz(micros: Column) -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))


def resolve_created_at(created_at: Column, rkey: Column, received: Column) -> tuple[Column, Column]:
    """(time, anomaly or null): the stated time if in the window, else the id's time, else the time of receipt.

    Only ISO 8601 times are read. The window runs from the earliest date to FUTURE_HOURS after receipt, ends included.
    """
    low, high = F.lit(EARLIEST).cast("timestamp_ntz"), received + F.expr(f"INTERVAL {FUTURE_HOURS} HOURS")
    iso = F.when(created_at.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(created_at)).cast("timestamp_ntz")
    tid = micros_ntz(tid_micros(rkey))
    good = lambda t: F.coalesce((t >= low) & (t <= high), F.lit(False))
    time = F.when(good(iso), iso).when(good(tid), tid).otherwise(received)
    anomaly = F.when(good(iso), F.lit(None)).when(good(tid), F.lit("createdat-tid-fallback")).otherwise(F.lit("createdat-receive-fallback"))
    return time, anomaly


def normalize_langs(langs: Column) -> Column:
    """Trimmed, without empty ones, distinct in order; never empty."""
    trimmed = F.transform(F.coalesce(langs, F.array().cast("array<string>")), lambda x: F.regexp_replace(x, r"^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$", ""))
    kept = F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull() & (x != "")))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit("unknown")))


def bucket_of(did: Column, n: int = 6) -> Column:
    """Shard bucket from the last three characters; a missing one counts 0."""
    code = lambda k: F.when(F.length(did) >= k, F.ascii(F.substring(did, -k, 1))).otherwise(0)
    return ((code(1) + 31 * code(2) + 961 * code(3)) % n).cast("long")


def key_hash(rkey: Column) -> Column:
    """First eight bytes of the SHA-256, little-endian, as a long."""
    h = F.sha2(rkey.cast("binary"), 256)
    le = F.concat(*[F.substring(h, k, 2) for k in range(15, 0, -2)])
    half = lambda k: F.conv(F.substring(le, k, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def digest(rkey: Column) -> Column:
    """Aggregate: order-free XOR digest of a set of keys, 16 hex digits. Repeated keys cancel, so make them distinct first."""
    return F.lower(F.lpad(F.hex(F.bit_xor(key_hash(rkey))), 16, "0"))


def canonical_host(endpoint: Column) -> Column:
    """Lower-case host with a port that is not the scheme's own; http keeps its scheme; null for other text."""
    scheme, host = F.lower(F.try_parse_url(endpoint, F.lit("PROTOCOL"))), F.lower(F.try_parse_url(endpoint, F.lit("AUTHORITY")))
    host = F.regexp_replace(host, "^.*@", "")
    return F.when(scheme == "https", F.regexp_replace(host, ":443$", "")).when(scheme == "http", F.concat(F.lit("http://"), F.regexp_replace(host, ":80$", "")))


def logical_shard(shard: Column) -> Column:
    return F.regexp_replace(shard, "^(overcap-long-|overcap-)shard", "shard")


def deadness(message: Column) -> Column:
    """Kind of a hard failure of a host, or null."""
    return F.when(F.contains(message, F.lit("ENOTFOUND")), "dns").when(message.rlike(r"http 451\b"), "legal").when(F.contains(message, F.lit("stalled:")), "stall")


def retry_delay(attempts: Column, base: float, most: float, hint: Column | None = None) -> Column:
    """Exponential backoff with a ceiling; a hint can only lengthen it."""
    delay = F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempts), F.lit(float(most)))
    return delay if hint is None else F.greatest(delay, F.coalesce(hint, F.lit(0.0)))


def retry_after_seconds(value: Column, now_epoch: Column) -> Column:
    """A Retry-After header: seconds, or an HTTP date against the present second."""
    date = F.unix_timestamp(F.try_to_timestamp(F.regexp_replace(value, "^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss")))
    return F.when(value.rlike(r"^\d+(\.\d+)?$"), value.try_cast("double")).otherwise(F.greatest(date - now_epoch, F.lit(0)).cast("double"))


def http_outcome(status: Column, error: Column) -> Column:
    """Terminal state of a failed fetch, or retry."""
    return (
        F.when(error == "RepoTakendown", "takendown").when(error == "RepoSuspended", "takendown").when(error == "RepoDeactivated", "deactivated")
        .when(error == "RepoNotFound", "failed").when((status == 429) | (status >= 500), "retry").when(status.between(400, 499), "failed").otherwise("retry")
    )


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.format_string("%.4f", part / whole)).otherwise("N/A")


def eta_hours(remaining: Column, per_minute: Column) -> Column:
    return F.when(per_minute > 0, remaining / per_minute / 60)


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def human_bytes(n: Column) -> Column:
    steps = [(40, "TiB"), (30, "GiB"), (20, "MiB"), (10, "KiB")]
    out = F.concat(n.cast("string"), F.lit(" B"))
    for power, unit in reversed(steps):
        out = F.when(n >= (1 << power), F.concat(F.format_string("%.1f ", n / float(1 << power)), F.lit(unit))).otherwise(out)
    return out


def human_duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    return (
        F.when(s >= 86400, F.format_string("%dd %dh", F.floor(s / 86400), F.floor(s % 86400 / 3600)))
        .when(s >= 3600, F.format_string("%dh %dm", F.floor(s / 3600), F.floor(s % 3600 / 60)))
        .when(s >= 60, F.format_string("%dm %ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%ds", s))
    )


def flag_of(lang: Column) -> Column:
    """Flag of a language code's usual country, or the white flag."""
    #: Language to country.
    countries = {"en": "US", "ja": "JP", "pt": "BR", "de": "DE", "fr": "FR", "es": "ES", "ko": "KR", "it": "IT", "nl": "NL", "tr": "TR", "uk": "UA", "zh": "CN"}
    flags = {k: "".join(chr(0x1F1E6 + ord(c) - 65) for c in v) for k, v in countries.items()}
    table = F.create_map(*[F.lit(x) for kv in flags.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(lang)), F.lit("\U0001f3f3️"))


def strings_of_json(value: Column) -> Column:
    """A JSON array of strings; anything else is empty."""
    return F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))


def floor_seconds(ts: Column, step: Column) -> Column:
    """Start of the `step`-second bucket, counted from the epoch, of a time without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", epoch, ts)
    return F.floor(seconds / step) * step


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")
