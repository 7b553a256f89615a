"""Personal data and secrets in free text, nested columns and JSON documents.

Every pattern has a cheap necessary condition (a substring test) in front of it, so clean text, the bulk of any
corpus, never reaches the regular expression engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.functions.text import chain, let, replace_matches

# Labels, patterns and words that results must agree on.
REDACTED = "[FILTERED]"
CARD_LABEL = "[CREDIT CARD FILTERED]"
IBAN_LABEL = "[IBAN FILTERED]"
SENSITIVE_WORDS = (
    "password", "passwd", "pwd",
    "secret", "apisecret", "clientsecret", "secretkey",
    "token", "accesstoken", "refreshtoken", "apikey", "apitoken", "authorization", "authtoken", "bearer",
    "sessiontoken", "csrftoken",
    "creditcard", "cardnumber", "cardnum", "cvv", "cvv2", "cvc",
    "iban", "accountnumber", "routingnumber", "bankaccount",
    "ssn", "socialsecuritynumber", "socialsecurity",
    "privatekey",
)
# The local part is possessive and starts only where a run starts (or right after a match), which keeps the scan
# linear. Patterns with \b, \d or \s carry (?U): those classes are Unicode-aware in this rule set.
EMAIL = r"(?:\G|(?<![a-zA-Z0-9._%+-]))[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
SSN = r"(?U)\b\d{3}-\d{2}-\d{4}\b"
CARD_FORMAT = r"(?U)\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,4}\b"
BEARER = r"(?Ui)\bBearer\s+[A-Za-z0-9\-._~+/]+=*"
# Only the first "ey" of a run can begin a token: the others would end in the same place. What is before it stays, as $1.
JWT = (
    r"(?U)(?<![A-Za-z0-9_-])((?:(?!\bey)[A-Za-z0-9_-])*+)"
    r"\bey[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}\b"
)
AWS_KEY = r"(?U)\bAKIA[0-9A-Z]{16}\b"
STRIPE_KEY = r"(?U)\b[sr]k_(?:live|test)_[A-Za-z0-9]{10,}\b"
GITHUB_TOKEN = r"(?U)\bgh[pousr]_[A-Za-z0-9]{20,}\b"
IBAN = (
    r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9_])"
)
CARD_PREFIX = (
    r"\A(?:4|5[1-5]|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9][0-9]|7[01][0-9]|720)|3[47]|6011|64[4-9]|65"
    r"|35(?:2[89]|[3-8][0-9])|36|30[0-5]|62)"
)
# Groups of digits joined by single separators, none touching a word character. Possessive throughout, so a run of
# any length needs no backtracking and no stack.
DIGIT_RUN = r"(?<![A-Za-z0-9_])[0-9]++(?![A-Za-z0-9_])(?:[ -][0-9]++(?![A-Za-z0-9_]))*+"
THIRTEEN_DIGITS = r"[0-9](?:[ -]?[0-9]){12}"
MAX_CARD_DIGITS = 19
# JSON: strings, marks, other scalars, and whatever is none of these. Unrolled and possessive, so it is linear.
JSON_TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]:,]|[^\s{}\[\]:,"]++|"'
JSON_SCALAR = r"\A(?:-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|true|false|null)\z"
JSON_CHUNK = 256
# What any text must hold for one of the rules to touch it.
ANYTHING = r"(?U)\d|@|(?i:bearer)|ey|AKIA|[sr]k_|gh[pousr]_"


def _has_any(c: Column, *needles: str) -> Column:
    test = c.contains(needles[0])
    for needle in needles[1:]:
        test = test | c.contains(needle)
    return test


# label -> (pattern, necessary condition), in the order the rules apply.
_PATTERNS = {
    "EMAIL": (EMAIL, lambda c: c.contains("@")),
    "SSN": (SSN, lambda c: c.contains("-") & c.rlike(r"(?U)\d-\d\d-\d")),
    "CREDIT CARD": (CARD_FORMAT, lambda c: c.rlike(r"(?U)\d[ -]\d{4}[ -]\d{4}[ -]\d")),
    "BEARER TOKEN": (BEARER, lambda c: F.lower(c).contains("bearer")),
    "JWT": (JWT, lambda c: c.contains("ey") & c.rlike(r"[A-Za-z0-9_-]{10}\.[A-Za-z0-9_-]{10}")),
    "AWS KEY": (AWS_KEY, lambda c: c.contains("AKIA")),
    "STRIPE KEY": (STRIPE_KEY, lambda c: _has_any(c, "k_live_", "k_test_")),
    "GITHUB TOKEN": (GITHUB_TOKEN, lambda c: _has_any(c, "ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
}


def _rule(label: str) -> Callable[[Column], Column]:
    pattern, possible = _PATTERNS[label]
    replacement = f"$1[{label} FILTERED]" if label == "JWT" else f"[{label} FILTERED]"
    return lambda t: F.when(possible(t), F.regexp_replace(t, pattern, replacement)).otherwise(t)


def _scrub(c: Column, label: str) -> Column:
    return let(c, _rule(label))


def scrub_email(c: Column) -> Column:
    return _scrub(c, "EMAIL")


def scrub_ssn(c: Column) -> Column:
    return _scrub(c, "SSN")


def scrub_card_format(c: Column) -> Column:
    return _scrub(c, "CREDIT CARD")


def scrub_bearer(c: Column) -> Column:
    return _scrub(c, "BEARER TOKEN")


def scrub_jwt(c: Column) -> Column:
    return _scrub(c, "JWT")


def scrub_aws(c: Column) -> Column:
    return _scrub(c, "AWS KEY")


def scrub_stripe(c: Column) -> Column:
    return _scrub(c, "STRIPE KEY")


def scrub_github(c: Column) -> Column:
    return _scrub(c, "GITHUB TOKEN")


def is_iban(c: Column) -> Column:
    """15 to 34 characters without spaces whose mod-97 remainder, first four characters last, is 1."""

    def check(compact: Column) -> Column:
        moved = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))
        symbols = F.transform(F.sequence(F.lit(1), F.length(compact)), lambda i: F.substr(moved, i, F.lit(1)))
        remainder = F.aggregate(
            symbols,
            F.lit(0),
            lambda acc, s: F.when(s.between("A", "Z"), (acc * 100 + F.ascii(s) - 55) % 97).otherwise(
                (acc * 10 + F.ascii(s) - 48) % 97
            ),
        )
        return F.when(F.length(compact).between(15, 34), remainder == 1).otherwise(False)

    return let(F.replace(c, F.lit(" "), F.lit("")), check)


def scrub_iban(c: Column) -> Column:
    def scan(t: Column) -> Column:
        redacted = replace_matches(t, IBAN, lambda m: F.when(is_iban(m), F.lit(IBAN_LABEL)).otherwise(m))
        return F.when(t.rlike(IBAN), redacted).otherwise(t)

    return let(c, scan)


def passes_luhn(digits: Column) -> Column:
    def total(reversed_digits: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            value = (F.ascii(F.substr(reversed_digits, i, F.lit(1))) - 48) * (F.lit(2) - i % 2)
            return acc + F.when(value > 9, value - 9).otherwise(value)

        return F.aggregate(F.sequence(F.lit(1), F.length(reversed_digits)), F.lit(0), add) % 10 == 0

    return F.when(F.length(digits) > 0, let(F.reverse(digits), total)).otherwise(True)


def is_card(digits: Column) -> Column:
    """13 to 19 digits with a card network's prefix and a valid check digit."""
    def check(d: Column) -> Column:
        shaped = F.length(d).between(13, MAX_CARD_DIGITS) & d.rlike(CARD_PREFIX)
        return F.when(shaped, passes_luhn(d)).otherwise(False)

    return let(digits, check)


def _scrub_run(run: Column) -> Column:
    """One digit run: from each group on, the longest stretch of whole groups that is a card is replaced."""
    groups = F.split(run, "[ -]", -1)
    separators = F.concat(F.regexp_extract_all(run, F.lit("[ -]"), F.lit(0)), F.array(F.lit("")))

    def scan(parts: Column) -> Column:
        group, separator, count = parts["g"], parts["s"], F.size(parts["g"])

        def longest(i: Column) -> Column:
            # A stretch of more groups than a card has digits cannot be a card.
            lasts = F.sequence(F.least(count - 1, i + MAX_CARD_DIGITS - 1), i)
            cards = F.filter(lasts, lambda j: is_card(F.array_join(F.slice(group, i + 1, j - i + 1), "")))
            return F.struct(i.alias("first"), F.get(cards, F.lit(0)).alias("last"))

        def between(first: Column, length: Column) -> Column:
            text = F.zip_with(F.slice(group, first + 1, length), F.slice(separator, first + 1, length), lambda g, s: F.concat(g, s))
            return F.array_join(text, "")

        def take(state: Column, card: Column) -> Column:
            upto = between(state["next"], card["first"] - state["next"])
            taken = F.struct(
                F.concat(state["out"], upto, F.lit(CARD_LABEL), F.get(separator, card["last"])).alias("out"),
                (card["last"] + 1).alias("next"),
            )
            return F.when(card["first"] < state["next"], state).otherwise(taken)

        starts = F.filter(
            F.transform(F.sequence(F.lit(0), count - 1), longest), lambda card: card["last"].isNotNull()
        )
        zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("next"))
        return F.aggregate(
            starts, zero, take, lambda state: F.concat(state["out"], between(state["next"], count - state["next"]))
        )

    scanned = let(F.struct(groups.alias("g"), separators.alias("s")), scan)
    return F.when(run.rlike(THIRTEEN_DIGITS), scanned).otherwise(run)


def scrub_cards(c: Column) -> Column:
    return let(
        c, lambda t: F.when(t.rlike(THIRTEEN_DIGITS), replace_matches(t, DIGIT_RUN, _scrub_run)).otherwise(t)
    )


def scrub_string(c: Column) -> Column:
    """IBANs first (a spaced IBAN looks like a formatted card), the patterns in order, then cards of any shape."""

    def scrub(t: Column) -> Column:
        steps = [scrub_iban, *[_rule(label) for label in _PATTERNS], scrub_cards]
        return F.when(t.rlike(ANYTHING), chain(t, *steps)).otherwise(t)

    return let(c, scrub)


def pii_labels(c: Column) -> Column:
    """Labels of the rules that hit a text, each rule seeing the text the rules before it left behind."""

    def marker(label: str, step: Callable[[Column], Column]) -> Callable[[Column], Column]:
        def mark(state: Column) -> Column:
            def compare(after: Column) -> Column:
                hit = F.when(after != state["text"], F.array_append(state["hits"], F.lit(label)))
                return F.struct(after.alias("text"), hit.otherwise(state["hits"]).alias("hits"))

            return let(step(state["text"]), compare)

        return mark

    rules = [("IBAN", scrub_iban), *[(label, _rule(label)) for label in _PATTERNS], ("CREDIT CARD", scrub_cards)]
    start = F.struct(c.alias("text"), F.array().cast("array<string>").alias("hits"))
    return F.array_distinct(chain(start, *[marker(label, step) for label, step in rules])["hits"])


def sensitive_name(name: str) -> bool:
    """Whether a field name, lowercased and stripped to letters and digits, contains a sensitive word."""
    plain = "".join(ch for ch in name.lower() if ch in "abcdefghijklmnopqrstuvwxyz0123456789")
    return any(word in plain for word in SENSITIVE_WORDS)


def is_sensitive_key(name: Column) -> Column:
    plain = F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    return F.coalesce(plain.rlike("|".join(SENSITIVE_WORDS)), F.lit(False))


def _has_text(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(sensitive_name(f.name) or _has_text(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_text(dtype.elementType)
    return isinstance(dtype, (T.StringType, T.MapType))


def _scrub_typed(c: Column, dtype: T.DataType, name: str) -> Column:
    """Any nesting, one level at a time. Array elements go by their array's name."""
    if sensitive_name(name):
        return F.when(c.isNotNull(), F.lit(REDACTED))
    if isinstance(dtype, T.StringType):
        return scrub_string(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: _scrub_typed(e, dtype.elementType, name))
    if isinstance(dtype, T.MapType):
        # A redacted value is text; in a map of anything else it can only be emptied.
        redacted = F.lit(REDACTED) if isinstance(dtype.valueType, T.StringType) else F.lit(None)
        return F.transform_values(
            c,
            lambda k, v: F.when(is_sensitive_key(k) & v.isNotNull(), redacted).otherwise(
                _scrub_typed(v, dtype.valueType, "")
            ),
        )
    if isinstance(dtype, T.StructType):
        fields = [_scrub_typed(c[f.name], f.dataType, f.name).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


Slots = list[Column]
Rebuild = Callable[[Callable[[int], Column]], Column]


def _slot(slots: Slots, texts: Column) -> int:
    slots.append(texts)
    return len(slots) - 1


def _plan(c: Column, dtype: T.DataType, name: str, slots: Slots, pieces: dict[str, Column]) -> Rebuild:
    """Hand a column's strings over to ``slots``, and say how the column is put together again from them.

    ``pieces`` holds the tokens of columns that are JSON text.
    """
    if sensitive_name(name.rsplit(".", 1)[-1]):
        return lambda get: F.when(c.isNotNull(), F.lit(REDACTED))
    if name in pieces:
        found = pieces[name]
        i = _slot(slots, F.transform(found, lambda p: p["text"]))
        joined = lambda get: let(_json_items(found, get(i)), lambda items: _json_joined(c, items))
        return lambda get: F.when(c.isNotNull(), joined(get))
    if isinstance(dtype, T.StringType):
        i = _slot(slots, F.array(c))
        return lambda get: F.get(get(i), F.lit(0))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        i = _slot(slots, c)
        return lambda get: get(i)
    if isinstance(dtype, T.MapType) and isinstance(dtype.valueType, T.StringType):
        i = _slot(slots, F.map_values(c))

        def remap(get):
            def value(k, v):
                return F.when(is_sensitive_key(k) & v.isNotNull(), REDACTED).otherwise(v)

            return F.map_from_arrays(F.map_keys(c), F.zip_with(F.map_keys(c), get(i), value))

        return remap
    if isinstance(dtype, T.StructType):
        parts = {f.name: _plan(c[f.name], f.dataType, f"{name}.{f.name}", slots, pieces) for f in dtype.fields}
        return lambda get: F.when(c.isNotNull(), F.struct(*[part(get).alias(n) for n, part in parts.items()]))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        fields = dtype.elementType.fields
        if all(isinstance(f.dataType, T.StringType) or not _has_text(f.dataType) for f in fields):
            return _plan_records(c, fields, name, slots, pieces)
    if _has_text(dtype):
        return lambda get: _scrub_typed(c, dtype, name)
    return lambda get: c


def _plan_records(c: Column, fields: list[T.StructField], name: str, slots: Slots, pieces: dict[str, Column]) -> Rebuild:
    """An array of flat records: one slot per text field, holding that field of every record."""

    def picker(f: T.StructField):
        path = f"{name}.{f.name}"
        if path in pieces:
            found = pieces[path]
            i = _slot(slots, F.transform(found, lambda p: p["text"]))

            def joined(text: Column, at: Column, get) -> Column:
                own = F.filter(_json_items(found, get(i)), lambda item: item["document"] == at)
                return let(own, lambda items: _json_joined(text, items))

            return lambda e, at, get: F.when(e[f.name].isNotNull(), joined(e[f.name], at, get))
        if sensitive_name(f.name):
            return lambda e, at, get: F.when(e[f.name].isNotNull(), F.lit(REDACTED))
        if isinstance(f.dataType, T.StringType):
            i = _slot(slots, F.transform(c, lambda e: e[f.name]))
            return lambda e, at, get: F.get(get(i), at)
        return lambda e, at, get: e[f.name]

    pickers = {f.name: picker(f) for f in fields}

    def rebuild(get):
        return F.transform(
            c, lambda e, at: F.struct(*[pick(e, at, get).alias(n) for n, pick in pickers.items()])
        )

    return rebuild


def scrub_columns(df: DataFrame, cols: list[str] | None = None, json_cols: tuple[str, ...] = ()) -> DataFrame:
    """Scrub typed columns by their schema, and the named JSON text columns as documents (``trail.data`` names the
    ``data`` of the records of an array ``trail``).

    The strings of all columns are scrubbed together, so a wide record costs one copy of the rules in the plan.
    """
    chosen = [f for f in df.schema.fields if cols is None or f.name in cols]
    documents = {}
    for path in json_cols:
        top, _, field = path.partition(".")
        texts = F.transform(top, lambda e: e[field]) if field else F.array(top)
        documents[path] = _json_tokens(texts)
    held = {f"__pieces_{i}": d for i, d in enumerate(documents.values())}
    pieces = {path: F.col(f"__pieces_{i}") for i, path in enumerate(documents)}
    slots: Slots = []
    plans = {f.name: _plan(F.col(f.name), f.dataType, f.name, slots, pieces) for f in chosen}
    taken = df.withColumns(held) if held else df
    if slots:
        taken = taken.withColumn("__slots", F.transform(F.array(*slots), lambda s: F.transform(s, scrub_string)))
    done = {n: plan(lambda i: F.get(F.col("__slots"), F.lit(i))) for n, plan in plans.items()}
    return taken.withColumns(done).drop("__slots", *held)


def _unquoted(raw: Column) -> Column:
    """The text of a JSON string. One with an escape that means nothing is taken as it stands."""
    inner = F.substr(raw, F.lit(2), F.length(raw) - 2)
    decoded = F.from_json(F.concat(F.lit('{"s":'), raw, F.lit("}")), "s string")["s"]
    return F.when(F.contains(raw, F.lit("\\")), F.coalesce(decoded, inner)).otherwise(inner)


def _json_tokens(texts: Column) -> Column:
    """The tokens of an array of JSON documents: which document, the token, and what a string says."""

    def tokens(text: Column, document: Column) -> Column:
        found = F.coalesce(F.regexp_extract_all(text, F.lit(JSON_TOKEN), F.lit(0)), F.array().cast("array<string>"))
        is_text = lambda raw: raw.startswith('"') & (F.length(raw) > 1)
        return F.transform(
            found,
            lambda raw: F.struct(
                document.alias("document"), raw.alias("raw"), F.when(is_text(raw), _unquoted(raw)).alias("text")
            ),
        )

    return F.flatten(F.transform(texts, tokens))


def _json_quoted(c: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(c.alias("s"))), r'(?s)\A\{"s":(.*)\}\z', 1)


def _json_items(tokens: Column, texts: Column) -> Column:
    """Tokens with their kind (a mark, ``s`` text, ``n`` another scalar, ``?`` neither), as they go out, and whether as a
    key they ask for redaction. Text that no rule touched goes out as it came in."""

    def item(p: Column, text: Column) -> Column:
        kind = F.when(p["text"].isNotNull(), "s").when(p["raw"].rlike(r"\A[{}\[\]:,]\z"), p["raw"])
        kind = kind.when(p["raw"].rlike(JSON_SCALAR), "n").otherwise("?")
        out = F.when(p["text"].isNull() | (text == p["text"]), p["raw"]).otherwise(_json_quoted(text))
        return F.struct(
            p["document"].alias("document"), kind.alias("kind"), p["raw"].alias("raw"), out.alias("out"),
            F.when(p["text"].isNotNull(), is_sensitive_key(p["text"])).otherwise(False).alias("hides"),
        )

    return F.zip_with(tokens, texts, item)


def _json_step(state: Column, item: Column) -> Column:
    """One token. ``stack`` holds the open marks and ``want`` what may follow: a (v)alue, a value or the end of a list (V),
    a key or the end of an object (k), a key (K), a colon, a comma or an end (e), nothing (x). ``cut`` is the depth of the
    value that is being left out, 0 outside of one, and ``hides`` says that the next value has to be."""
    kind, stack, want, cut = item["kind"], state["stack"], state["want"], state["cut"]
    depth, top = F.length(stack), F.right(stack, F.lit(1))
    value = want.isin("v", "V")
    opens = kind.isin("{", "[") & value
    closes = ((kind == "}") & (top == "{") & want.isin("k", "e")) | ((kind == "]") & (top == "[") & want.isin("V", "e"))
    key = (kind == "s") & want.isin("k", "K")
    scalar = kind.isin("s", "n") & value
    colon, comma = (kind == ":") & (want == ":"), (kind == ",") & (want == "e")
    shown = F.when(state["hides"] & (opens | scalar), F.lit(f'"{REDACTED}"')).when(key, item["raw"]).otherwise(item["out"])
    return F.struct(
        F.when(opens, F.concat(stack, kind)).when(closes, F.left(stack, depth - 1)).otherwise(stack).alias("stack"),
        F.when(opens, F.when(kind == "{", "k").otherwise("V"))
        .when(closes, F.when(depth > 1, "e").otherwise("x"))
        .when(scalar, F.when(depth > 0, "e").otherwise("x"))
        .when(key, ":").when(colon, "v")
        .when(comma, F.when(top == "{", "K").otherwise("v")).otherwise(want).alias("want"),
        F.when((cut == 0) & opens & state["hides"], depth + 1).when(closes & (cut == depth), 0).otherwise(cut).alias("cut"),
        F.when(key, item["hides"]).otherwise(state["hides"] & colon).alias("hides"),
        (state["ok"] & (opens | closes | key | scalar | colon | comma)).alias("ok"),
        F.when(cut == 0, F.concat(state["out"], shown)).otherwise(state["out"]).alias("out"),
    )


def _json_joined(text: Column, items: Column) -> Column:
    """A document put together from its tokens. What does not scan as JSON is scrubbed as text, and redacted whole if it
    looks like a document and holds a sensitive word, because its values cannot be told apart.

    Output is gathered in chunks, so a long document is not copied for each of its tokens.
    """
    start = F.struct(
        F.lit("").alias("stack"), F.lit("v").alias("want"), F.lit(0).alias("cut"), F.lit(False).alias("hides"),
        F.lit(True).alias("ok"), F.lit("").alias("out"),
    )
    carried = ("stack", "want", "cut", "hides", "ok")

    def chunk(state: Column, number: Column) -> Column:
        fresh = F.struct(*(state[n].alias(n) for n in carried), F.lit("").alias("out"))
        part = F.aggregate(F.slice(items, number * JSON_CHUNK + 1, JSON_CHUNK), fresh, _json_step)
        return let(part, lambda p: F.struct(*(p[n].alias(n) for n in carried), F.concat(state["out"], p["out"]).alias("out")))

    chunks = F.sequence(F.lit(0), F.floor(F.size(items) / JSON_CHUNK).cast("int"))
    hidden = text.rlike(r"\A\s*+[{\[]") & is_sensitive_key(text)
    plain = F.when(hidden, F.lit(REDACTED)).otherwise(scrub_string(text))
    whole = lambda state: F.when(state["ok"] & (state["want"] == "x"), state["out"]).otherwise(plain)
    return let(F.aggregate(chunks, start, chunk), whole)


def scrub_json(c: Column) -> Column:
    """Scrub a JSON document of any shape and depth. Numbers, repeated keys and escapes stay as they are written."""

    def scrub(text: Column) -> Column:
        def join(tokens: Column) -> Column:
            texts = F.transform(tokens, lambda p: scrub_string(p["text"]))
            return let(_json_items(tokens, texts), lambda items: _json_joined(text, items))

        return let(_json_tokens(F.array(text)), join)

    return F.when(c.isNotNull(), let(c, scrub))


def pii_findings(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per record and rule that hit it."""
    return df.select(F.col(id_col), F.explode(pii_labels(F.col(text_col))).alias("label"))
