"""Text functions of requests, diagnostics and identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "***"

# What names a credential, what announces one, and headers that carry one.
SECRET_NAMES = ("password", "passwd", "secret", "token", "authorization", "credential")
SCHEMES = ("bearer", "basic")
SENSITIVE_HEADERS = ("authorization", "proxy-authorization", "cookie", "set-cookie", "x-auth-token", "x-usertoken")
# Statuses worth another attempt, and words in a 409 that say so.
RETRYABLE = (408, 425, 429, 500, 502, 503, 504)
TRANSIENT = "try again|temporar|busy|lock|in progress|timed? ?out|unavailable|overload"
HTTP_DATE = "EEE, d MMM yyyy HH:mm:ss 'GMT'"
#: Characters that end a word of a body, and those that a credential is made of.
_MARKS, _CREDENTIAL = r'"&?\s=', "A-Za-z0-9._~+/=-"


def percent_encode(c: Column) -> Column:
    """RFC 3986: only unreserved characters pass, a space is %20."""
    out = F.url_encode(c)
    for found, put in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(found), F.lit(put))
    return out


def request_path(table: Column, query: Column, *, fields: Column | None = None, limit: int = 1000, offset: int = 0, display: str = "false", exclude_link: bool = True, no_domain: bool = False, category: str | None = None) -> Column:
    """The path and ordered parameters of a list request; empty ones are left out."""
    parts: list[tuple[str, Column]] = [("sysparm_query", F.nullif(query, F.lit("")))]
    if fields is not None:
        parts.append(("sysparm_fields", F.nullif(fields, F.lit(""))))
    parts.append(("sysparm_limit", F.lit(str(limit))))
    if offset:
        parts.append(("sysparm_offset", F.lit(str(offset))))
    parts += [("sysparm_display_value", F.lit(display)), ("sysparm_exclude_reference_link", F.lit(str(exclude_link).lower()))]
    if no_domain:
        parts.append(("sysparm_query_no_domain", F.lit("true")))
    if category:
        parts.append(("sysparm_query_category", F.lit(category)))
    parts += [("sysparm_no_count", F.lit("true")), ("sysparm_suppress_pagination_header", F.lit("true"))]
    return F.concat(F.lit("/api/now/table/"), table, F.lit("?"), F.concat_ws("&", *(F.concat(F.lit(f"{k}="), percent_encode(v)) for k, v in parts)))


def normalise_query(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\s+", " ")


def fingerprint(table: Column, query: Column, domain: Column) -> Column:
    """Identity of a stream: its table, its query up to white space, and its domain."""
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("\n", table, normalise_query(query), domain.cast("string")), 256))


def instance_host(url: Column) -> Column:
    """Lower-case host of an http or https URL; null for anything else."""
    return F.when(url.rlike(r"(?i)^\s*https?://[^/?#\s]+/*"), F.lower(F.try_parse_url(F.trim(url), F.lit("HOST"))))


def normalise_id(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def is_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{32}$"), F.lit(False))


def is_table(c: Column) -> Column:
    return F.coalesce(c.rlike("^[a-z0-9_]+$"), F.lit(False))


def _names_secret(name: Column) -> Column:
    low, found = F.lower(name), F.lit(False)
    for word in SECRET_NAMES:
        found = found | low.contains(word)
    return found


def _without_members(c: Column) -> Column:
    """A body read once, mark by mark: strings of secret names and what follows a secret name= are hidden."""
    pieces = F.regexp_extract_all(c, F.lit(rf'\\["\\]|[{_MARKS}]|[^{_MARKS}\\]+|\\'), F.lit(0))
    none = F.lit("")
    start = F.struct(none.alias("done"), none.alias("hides"), F.lit(False).alias("quoted"), none.alias("string"), none.alias("between"), none.alias("name"))

    def step(s: Column, p: Column) -> Column:
        quote, ends = p == '"', p.rlike(r"^[&\s]$")
        free, json, form = (s["hides"] == x for x in ("", "json", "form"))
        opens = free & quote & ~s["quoted"] & (F.regexp_replace(s["between"], r"\s", "") == ":") & _names_secret(s["string"])
        equals = free & (p == "=") & ~s["name"].contains("=") & _names_secret(s["name"])
        text = F.when((json & ~quote) | (form & ~ends), "").when(opens, f'"{MASK}').when(equals, f"={MASK}").otherwise(p)
        return F.struct(
            F.concat(s["done"], text).alias("done"),
            F.when(opens, "json").when(equals, "form").when((json & quote) | (form & ends), "").otherwise(s["hides"]).alias("hides"),
            F.when(quote, ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"),
            F.when(quote & ~s["quoted"], "").when(quote | ~s["quoted"], s["string"]).otherwise(F.concat(s["string"], p)).alias("string"),
            F.when(quote, "").when(s["quoted"], s["between"]).otherwise(F.concat(s["between"], p)).alias("between"),
            F.when(p.rlike(r"^[&?\s]$"), "").otherwise(F.concat(s["name"], p)).alias("name"),
        )

    return F.aggregate(pieces, start, step, lambda s: s["done"])


def _without_schemes(c: Column) -> Column:
    """A text whose words after the name of a scheme lose their credential."""
    words = F.regexp_extract_all(c, F.lit(r"\s+|\S+"), F.lit(0))

    def shown(word: Column, i: Column) -> Column:
        scheme = F.regexp_extract(F.lower(F.coalesce(F.try_element_at(words, F.greatest(i - 1, F.lit(1))), F.lit(""))), r"(\w+)$", 1)
        return F.when((i > 1) & scheme.isin(*SCHEMES), F.regexp_replace(word, f"^[{_CREDENTIAL}]+", MASK)).otherwise(word)

    return F.array_join(F.transform(words, shown), "")


def redact_body(c: Column) -> Column:
    """A JSON, form or free-text body with its credentials masked.

    What is hidden: the string after "name": if the name, the last string
    before it, speaks of a credential; what follows name= up to a blank or &, if
    the name does; and the credential after a scheme's name.
    """
    return _without_schemes(_without_members(c))


def redact_headers(headers: Column) -> Column:
    """A map of header lists as {name=[values], ...}, by name regardless of case, credentials masked."""
    shown = F.transform(
        F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("low"), e["key"].alias("name"), e["value"].alias("value")))),
        lambda e: F.concat(e["name"], F.lit("=["), F.when(e["low"].isin(*SENSITIVE_HEADERS), F.lit(MASK)).otherwise(F.array_join(e["value"], ", ")), F.lit("]")),
    )
    return F.concat(F.lit("{"), F.coalesce(F.array_join(shown, ", "), F.lit("")), F.lit("}"))


def excerpt(c: Column, size: int = 500) -> Column:
    """The redacted body's first characters."""
    r = redact_body(F.coalesce(c, F.lit("")))
    return F.when(F.length(r) > size, F.concat(F.substring(r, 1, size), F.lit("..."))).otherwise(r)


def error_text(body: Column) -> Column:
    """'message: detail' of an error body in either of its forms; null if it isn't a JSON object."""
    plain = F.get_json_object(body, "$.error")
    nested = F.get_json_object(body, "$.error.message")
    is_object = plain.startswith("{")
    message = F.when(is_object, nested).otherwise(plain)
    detail = F.when(is_object, F.get_json_object(body, "$.error.detail")).otherwise(F.get_json_object(body, "$.error_description"))
    detail = F.when(F.trim(detail).isin("", "null"), None).otherwise(detail)
    return F.when(F.trim(body).startswith("{"), F.concat_ws(": ", message, detail))


def is_retryable(status: Column, error: Column) -> Column:
    return F.coalesce(status.isin(*RETRYABLE) | ((status == 409) & error.rlike(f"(?i){TRANSIENT}")), F.lit(False))


def classify(status: Column, *, exhausted: Column | None = None, ambiguous: Column | None = None) -> Column:
    """A failed write's class; null status means that no answer came."""
    c = F.when(F.coalesce(exhausted, F.lit(False)), "RETRIES_EXHAUSTED") if exhausted is not None else F.when(F.lit(False), "")
    c = c.when(status == 403, "PERMISSION").when(status == 404, "NOT_FOUND").when(status == 409, "CONFLICT").when(status.isNotNull(), "RECORD_ERROR")
    if ambiguous is not None:
        c = c.when(ambiguous, "AMBIGUOUS")
    return c.otherwise("RECORD_ERROR")


def _epoch(c: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(F.regexp_replace(c, r"^\w{3}, ", ""), F.lit("d MMM yyyy HH:mm:ss 'GMT'")))


def retry_after(value: Column, now: Column) -> Column:
    """Seconds to wait: a delta or an HTTP date against now (epoch seconds), never negative; null if neither."""
    return F.greatest(F.coalesce(F.trim(value).try_cast("bigint"), _epoch(F.trim(value)) - now), F.when(value.isNotNull() & F.coalesce(F.trim(value).try_cast("bigint"), _epoch(F.trim(value))).isNotNull(), F.lit(0)))


def rate_reset(value: Column, now: Column) -> Column:
    """Epoch seconds of a reset: an epoch if it looks like one, else a delta; or an HTTP date."""
    n = F.trim(value).try_cast("bigint")
    return F.when(n > 1_000_000_000, n).when(n.isNotNull(), now + n).otherwise(_epoch(F.trim(value)))


def wait_for(wait: Column, observed: Column, now: Column, *, remaining: Column, reset: Column) -> Column:
    """Seconds still to wait: the rest of a told wait, or until the reset of a used-up quota; null if neither holds."""
    rest = F.greatest(wait - (now - observed), F.lit(0))
    return F.when(wait.isNotNull(), rest).when((remaining <= 0) & reset.isNotNull(), F.greatest(reset - now, F.lit(0)))


def remaining_fraction(limit: Column, remaining: Column) -> Column:
    """The share of a quota that is left, never negative; null without a quota."""
    return F.when((limit > 0) & remaining.isNotNull(), F.greatest(remaining / limit, F.lit(0.0)))


def backoff_ceiling(attempt: Column, *, initial_ms: int = 500, cap_ms: int = 30_000) -> Column:
    """Most milliseconds before the next attempt; full jitter draws below it."""
    exponent = F.least(F.greatest(attempt - 1, F.lit(0)), F.lit(30)).cast("int")
    return F.least(F.lit(cap_ms).cast("bigint"), (F.lit(initial_ms) * F.pow(F.lit(2.0), exponent)).cast("bigint"))


def retry_decision(retryable: Column, idempotent: Column, ambiguous: Column, attempt: Column, elapsed_ms: Column, wait_ms: Column, *, attempts: int = 5, budget_ms: int = 300_000) -> Column:
    """'fail', 'exhausted' or 'retry' after a failed attempt; the milliseconds may be of any integer type, and their sum is a long."""
    may = retryable & (idempotent | ~ambiguous)
    return F.when(~may, "fail").when(attempt >= attempts, "exhausted").when(elapsed_ms.cast("bigint") + wait_ms > budget_ms, "exhausted").otherwise("retry")


def is_idempotent(method: Column) -> Column:
    return F.upper(method) != "POST"


def reconcile_timestamp(c: Column) -> Column:
    """ISO or plain to plain: T becomes a space, a final Z and a fraction go; blank is null."""
    t = F.regexp_replace(F.replace(F.trim(c), F.lit("T"), F.lit(" ")), "Z$", "")
    t = F.when((F.length(t) > 19) & F.substring(t, 20, 1).isin(".", "+"), F.substring(t, 1, 19)).otherwise(t)
    return F.nullif(t, F.lit(""))


def config_timestamp(c: Column) -> Column:
    """A date to its midnight, ISO to plain, anything else as it is."""
    v = F.trim(c)
    iso = F.regexp_replace(F.replace(v, F.lit("T"), F.lit(" ")), "Z+$", "")
    plain = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
    return F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(v, F.lit(" 00:00:00"))).when(v.rlike(plain), v).when(iso.rlike(plain), iso).otherwise(v)


def json_text(body: Column, path: str) -> Column:
    """A member as text: strings as they are, anything else as JSON."""
    return F.get_json_object(body, path)
