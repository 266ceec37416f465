"""Secret scan: pattern rules, and sliding-window entropy over candidate strings.

Everything is a column expression: a document is read once by a few regular
expressions and no row is exploded or shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# The base patterns of the contract, in its order of kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_START = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the run is maximal either way, so the length may stand in the pattern
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "entropy"]

#: Characters of a candidate; the place in this text is a character's number.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=- "
#: Last number of each class of characters, in the order of ``ALPHABET``: A-F, G-Z, a-f, g-z, digits, others, space.
CLASSES = {"hex_upper": 6, "upper": 26, "hex_lower": 32, "lower": 52, "digits": 62, "others": 67, "blank": 68}
#: Runs of at least this many such characters, one a digit, are candidates.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits by character class of a window.  Measured on windows of 20 characters with a digit: camel-case names and
#: words run together with numbers reach 3.3 to 3.8 as base64 (4.1 at most); random keys of 24 and 40 characters
#: reach 3.9 and 4.0 in all but 5 of 100.  No window of 20 has exactly these bits, so rounding never decides.
BITS = {"digits": 2.75, "hex": 2.95, "upper": 3.55, "base64": 3.85}
#: Whole candidates that look random and are public: UUIDs, repeated examples.
ALLOWED = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|^(.{1,4})\1{4,}$"
#: Words of examples; what stands around them in a candidate is judged without them.
PUBLIC = ["example", "placeholder", "changeme", "0123456789", "abcdefgh"]
#: A candidate of which a quarter of the parts between separators are plain words or short numbers is a name, path or
#: list of numbers: its parts are judged each by itself.  Few parts of a key or of an encoded file are, so it stays whole.
PLAIN = r"^([A-Za-z]?[a-z]{2,}|[0-9]{1,8})$"
PLAIN_SHARE = 4
SEPARATORS = "_/=-"  # as a class of a pattern, with the dash last
#: Characters between two high windows from which they are two stretches; a part that is not judged may lie between.
JOIN = 24
#: Values that are added up in one go; longer arrays are added up block by block, so the work grows with the length.
RUN = 128
#: Code points of the pieces a text is cut into before parts of it are taken.
PIECE = 4096


def _with(fields: dict, then) -> Column:
    """``then`` of a struct of ``fields``: as fields of a lambda's variable they are worked out once."""
    return F.transform(F.array(F.struct(*[c.alias(n) for n, c in fields.items()])), then)[0]


def _running(numbers: Column, combine, zero: int = 0) -> Column:
    """``combine`` of the numbers up to and with each, in time that grows with their number.

    An array that grows inside ``aggregate`` is copied each time; so only the
    blocks of ``RUN`` numbers, and one number a block, are run through that way.
    """
    def through(values, carry):
        start = F.struct(carry.alias("at"), F.array().cast("array<bigint>").alias("out"))

        def step(state, x):
            now = combine(state["at"], x)
            return F.struct(now.alias("at"), F.concat(state["out"], F.array(now)).alias("out"))
        return F.aggregate(values, start, step, lambda t: t["out"])

    def blocks_of(s):
        count = F.floor((F.size(s["n"]) - 1) / RUN).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(s["n"], b * RUN + 1, RUN))
        return _with({"blocks": blocks}, lambda t: _with(
            {"blocks": t["blocks"], "ends": through(F.transform(t["blocks"], lambda b: F.aggregate(b, first, combine)), first)},
            lambda u: F.flatten(F.transform(u["blocks"], lambda b, i: through(b, F.when(i > 0, F.get(u["ends"], i - 1)).otherwise(first))))))

    first = F.lit(zero).cast("bigint")
    return F.when(F.size(numbers) > 0, _with({"n": numbers}, blocks_of)).otherwise(F.array().cast("array<bigint>"))


def _spans(text: Column, pattern: str, keep=None) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches, in code points.

    The places follow from the lengths of the matches and of the gaps between
    them, both of which one pass each returns.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(s):
        ends = _running(F.transform(s["found"], lambda f, i: (F.length(F.get(s["gaps"], i)) + F.length(f)).cast("bigint")), lambda x, y: x + y)
        return _with({"found": s["found"], "ends": ends}, lambda t: F.transform(t["found"], lambda f, i: F.struct(
            (F.get(t["ends"], i) - F.length(f)).alias("start"), F.get(t["ends"], i).alias("end"), f.alias("value"))))

    spans = _with({"found": found, "gaps": gaps}, placed)
    return F.filter(spans, keep) if keep else spans


def _empty_spans() -> Column:
    return F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")


def _judged(value: Column) -> Column:
    """A candidate with blanks in place of what is not judged: words of examples, and separators beside plain words."""
    rest = value
    for word in PUBLIC:
        rest = F.regexp_replace(rest, f"(?i){word}", " " * len(word))
    parts = F.filter(F.split(value, f"[{SEPARATORS}]"), lambda x: x != "")
    plain = F.size(F.filter(parts, lambda x: x.rlike(PLAIN)))
    wordy = (plain > 0) & (plain * PLAIN_SHARE >= F.size(parts))
    return F.when(wordy, F.translate(rest, SEPARATORS, " " * len(SEPARATORS))).otherwise(rest)


def high_entropy_spans(value: Column, window: int = WINDOW) -> Column:
    """(first, last) characters, from 0 and exclusive, of every stretch that windows above the bits of their class cover.

    A window is judged by the class of its own characters; it has no blank, and
    a stretch has a digit.  Windows less than ``JOIN`` apart make up one stretch.  The counts of
    the characters in the window, of their classes, and the sum of ``c * ln c``
    are carried along; one step adds a character and takes one out, so its cost
    does not depend on the window.
    """
    zeros = F.array_repeat(F.lit(0), len(ALPHABET))
    weight = lambda c: F.when(c > 1, c * F.log(c)).otherwise(F.lit(0.0))
    run = "struct<first:int,last:int>"
    none = F.lit(None).cast("int")
    classes = list(CLASSES)
    start = F.struct(zeros.alias("counts"), F.array_repeat(F.lit(0), len(classes)).alias("kinds"), F.lit(0.0).alias("sum"),
                     none.alias("first"), none.alias("last"), F.array().cast(f"array<{run}>").alias("runs"))

    def class_of(char):
        place = F.lit(len(classes))
        for i, name in reversed(list(enumerate(classes[:-1], 1))):
            place = F.when(char <= CLASSES[name], i).otherwise(place)
        return place

    def closed(state):
        return F.when(state["last"].isNull(), state["runs"]).otherwise(F.concat(
            state["runs"], F.array(F.struct(state["first"].alias("first"), state["last"].alias("last")))))

    def covered(numbers):
        def add(state, at, by):
            char = F.element_at(numbers, at)
            before = F.element_at(state["counts"], char)
            kind = class_of(char)
            return F.struct(F.transform(state["counts"], lambda c, i: c + F.when(i == char - 1, by).otherwise(0)).alias("counts"),
                            F.transform(state["kinds"], lambda c, i: c + F.when(i == kind - 1, by).otherwise(0)).alias("kinds"),
                            (state["sum"] + weight(before + by) - weight(before)).alias("sum"),
                            state["first"].alias("first"), state["last"].alias("last"), state["runs"].alias("runs"))

        def is_high(state, at):
            held = lambda *names: sum((state["kinds"][classes.index(n)] for n in names), F.lit(0))
            limit = (F.when(held("digits") == window, BITS["digits"])
                     .when((held("digits", "hex_lower") == window) | (held("digits", "hex_upper") == window), BITS["hex"])
                     .when(held("digits", "hex_upper", "upper") == window, BITS["upper"]).otherwise(BITS["base64"]))
            return ((at >= window) & (held("blank") == 0)
                    & (F.lit(math.log2(window)) - state["sum"] / (window * math.log(2)) > limit))

        def raised(state, at):
            apart = F.coalesce(at - window - state["last"] >= JOIN, F.lit(False))
            return F.struct(
                state["counts"].alias("counts"), state["kinds"].alias("kinds"), state["sum"].alias("sum"),
                F.when(state["last"].isNull() | apart, at - window).otherwise(state["first"]).alias("first"), at.alias("last"),
                F.when(apart, closed(state)).otherwise(state["runs"]).alias("runs"))

        def step(state, x):
            moved = add(state, x["at"], x["by"])
            # What came of the step is worked out once and then looked at.
            return _with({"state": moved, "at": x["at"], "by": x["by"]}, lambda m: F.when(
                (m["by"] == 1) & is_high(m["state"], m["at"]), raised(m["state"], m["at"])).otherwise(m["state"]))

        steps = F.flatten(F.transform(F.sequence(F.lit(1), F.size(numbers)), lambda at: F.array(
            F.struct((at - window).alias("at"), F.lit(-1).alias("by")), F.struct(at.alias("at"), F.lit(1).alias("by")))))
        return F.aggregate(F.filter(steps, lambda x: x["at"] >= 1), start, step, closed)

    characters = F.slice(F.split(value, ""), 1, F.length(value))
    runs = _with({"numbers": F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c))}, lambda k: covered(k["numbers"]))
    return F.filter(runs, lambda r: F.substring(value, r["first"] + 1, r["last"] - r["first"]).rlike("[0-9]"))


def scan_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with a column ``into``: (start, end, kind) of every span, by start and then kind.

    Places are code points, the end exclusive.  Kinds ``assign``, ``access``
    and ``hex`` follow the base patterns; ``entropy`` spans are the stretches of
    a candidate covered by windows above the bits of their class, unless the
    whole candidate is on the allow list or the stretch lies within a base span.
    Words of examples belong to no window, nor do the separators of a candidate
    that has plain words between them.  Null and empty texts have none; repeated
    rows are scanned each by itself; the work grows with the length of a text
    and the number of its spans; a column of the same name is replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("__text", body)
    for name, test, spans in (
        ("assign", ASSIGN_START, _spans(F.col("__text"), ASSIGN, lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 8)),
        ("access", "AKIA", _spans(F.col("__text"), ACCESS)),
        ("hex", HEX, _spans(F.col("__text"), HEX)),
        ("candidate", CANDIDATE, _spans(F.col("__text"), CANDIDATE, lambda s: ~s["value"].rlike(ALLOWED))),
    ):
        step = step.withColumn(f"__{name}", F.when(F.col("__text").rlike(test), spans).otherwise(_empty_spans()))
    def ranked(kind):
        rank = F.lit(KINDS.index(kind)).alias("rank")
        return F.transform(F.col(f"__{kind}"), lambda s: F.struct(s["start"].alias("start"), rank, s["end"].alias("end")))

    step = step.withColumn("__base", F.array_sort(F.concat(*map(ranked, KINDS[:3]))))
    entropy = KINDS.index("entropy")
    item = lambda start, rank, end, value: F.struct(
        start.alias("start"), rank.alias("rank"), end.alias("end"), value.alias("value"))
    based = F.transform("__base", lambda b: item(b["start"], b["rank"], b["end"], F.lit("")))

    def uncovered(stretches):
        """Without those that end no later than a base span that begins no later: by order, the furthest base end so far."""
        def kept(s):
            reach = _running(F.transform(s["all"], lambda x: F.when(x["rank"] == entropy, F.lit(-1)).otherwise(x["end"]).cast("bigint")),
                             lambda x, y: F.greatest(x, y), -1)
            return _with({"all": s["all"], "reach": reach}, lambda t: F.filter(
                t["all"], lambda x, i: (x["rank"] == entropy) & (F.get(t["reach"], i) < x["end"])))
        return _with({"all": F.array_sort(F.concat(based, stretches))}, kept)

    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,value:string>>")
    # A candidate within a base span has no stretch beyond it and is not looked at.
    candidates = F.transform("__candidate", lambda c: item(c["start"], F.lit(entropy), c["end"], c["value"]))
    step = step.withColumn("__candidate", F.when(F.size("__candidate") > 0, uncovered(candidates)).otherwise(none))
    raised = F.flatten(F.transform(F.col("__candidate"), lambda c: F.transform(high_entropy_spans(_judged(c["value"])), lambda r: item(
        (c["start"] + r["first"]), F.lit(entropy), (c["start"] + r["last"]), F.lit("")))))
    step = step.withColumn("__raised", F.when(F.size("__candidate") > 0, raised).otherwise(none))
    step = step.withColumn("__every", F.when(F.size("__raised") > 0, F.array_sort(F.concat(based, uncovered(F.col("__raised"))))).otherwise(based))
    names = F.array(*[F.lit(k) for k in KINDS])
    every = F.transform("__every", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at(names, s["rank"] + 1).alias("kind")))
    return step.withColumn(into, every).drop(
        "__text", "__base", "__raised", "__every", "__assign", "__access", "__hex", "__candidate")


def redact(docs: DataFrame, text: str = "text", spans: str = "secrets", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``spans`` replaced by ``mask``; overlapping spans become one.

    Spans come by their start.  The text is put together from the gaps between
    them, taken from pieces of it, so no gap is looked for from its beginning.
    """
    body = F.col(text)
    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def clean(s):
        def part(since, upto):
            first, last = F.floor(since / PIECE).cast("int"), F.floor((upto - 1) / PIECE).cast("int")
            held = F.array_join(F.slice(s["pieces"], first + 1, last - first + 1), "")
            return F.when(upto > since, F.substring(held, (since % PIECE + 1).cast("int"), (upto - since).cast("int"))).otherwise("")

        def masked(span, i):
            since = F.when(i > 0, F.get(s["reach"], i - 1)).otherwise(F.lit(0).cast("bigint"))
            return F.when(span["start"] >= since, F.concat(part(since, span["start"]), F.lit(mask))).otherwise("")

        tail = part(F.element_at(s["reach"], -1), F.length(body).cast("bigint"))
        return F.concat(F.array_join(F.transform(s["spans"], masked), ""), tail)

    reach = _running(F.transform(F.col(spans), lambda x: x["end"].cast("bigint")), lambda x, y: F.greatest(x, y))
    return docs.withColumn(text, F.when(F.size(spans) > 0, _with(
        {"pieces": pieces, "spans": F.col(spans), "reach": reach}, clean)).otherwise(body))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"))


def _oracle() -> str:
    def spans(name, pattern, keep):
        return f"""
    {name}_parts AS (
      SELECT rid, regexp_extract_all(body, '{pattern}') AS found, string_split_regex(body, '{pattern}') AS gaps
      FROM body WHERE regexp_matches(body, '{pattern}')
    ), {name}_spans AS (
      SELECT rid, unnest(list_transform(range(1, len(found) + 1), lambda i: {{
        'value': found[i],
        'start': coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0)
               + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0)}}), recursive := true)
      FROM {name}_parts
    ), {name} AS (
      SELECT rid, CAST(start AS BIGINT) AS start, CAST(start + length(value) AS BIGINT) AS stop, value
      FROM {name}_spans WHERE {keep}
    )"""

    assign = r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
    group = r"""^(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    uuid = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
    repeated = " OR ".join(f"(length(value) % {p} = 0 AND length(value) >= {5 * p} AND "
                           f"lower(value) = repeat(lower(left(value, {p})), length(value) // {p}))" for p in range(1, 5))
    blanked = "value"
    for word in PUBLIC:
        blanked = f"regexp_replace({blanked}, '(?i){word}', '{' ' * len(word)}', 'g')"
    parts = f"list_filter(string_split_regex(value, '[{SEPARATORS}]'), lambda x: x <> '')"
    plain = f"len(list_filter({parts}, lambda x: regexp_matches(x, '{PLAIN}')))"
    blanked = (f"CASE WHEN {plain} > 0 AND {plain} * {PLAIN_SHARE} >= len({parts}) "
               f"THEN translate({blanked}, '{SEPARATORS}', '{' ' * len(SEPARATORS)}') ELSE {blanked} END")
    return f"""
    WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
    body AS (SELECT rid, body FROM numbered),
    {spans('assign', assign, f"length(regexp_extract(value, '{group}', 1)) >= 8")},
    {spans('access', 'AKIA[A-Z0-9]{12,}', 'true')},
    {spans('hex', '[0-9a-f]{32,}', 'true')},
    {spans('cand', '[A-Za-z0-9+/_=-]{20,}', f"regexp_matches(value, '[0-9]') AND NOT regexp_matches(value, '{uuid}') AND NOT ({repeated})")},
    base AS (
      SELECT rid, 0 AS rank, 'assign' AS kind, start, stop FROM assign
      UNION ALL SELECT rid, 1, 'access', start, stop FROM access
      UNION ALL SELECT rid, 2, 'hex', start, stop FROM hex
    ), judged AS (SELECT rid, start, {blanked} AS value FROM cand
    ), windows AS (
      SELECT rid, start, value, pos, substr(value, CAST(pos AS INTEGER) + 1, {WINDOW}) AS w
      FROM (SELECT rid, start, value, unnest(range(0, length(value) - {WINDOW - 1})) AS pos FROM judged)
    ), raised AS (
      SELECT rid, start, value, pos, pos - lag(pos) OVER (PARTITION BY rid, start ORDER BY pos) AS step FROM windows
      WHERE NOT contains(w, ' ') AND list_aggregate(string_split(w, ''), 'entropy') >
        CASE WHEN regexp_full_match(w, '[0-9]+') THEN {BITS['digits']}
             WHEN regexp_full_match(w, '[0-9a-f]+|[0-9A-F]+') THEN {BITS['hex']}
             WHEN regexp_full_match(w, '[A-Z0-9]+') THEN {BITS['upper']} ELSE {BITS['base64']} END
    ), parted AS (
      SELECT rid, start, value, pos, count(*) FILTER (step >= {WINDOW + JOIN}) OVER (PARTITION BY rid, start ORDER BY pos) AS part FROM raised
    ), high AS (
      SELECT rid, parted.start + min(pos) AS start, parted.start + max(pos) + {WINDOW} AS stop FROM parted
      GROUP BY rid, parted.start, part
      HAVING regexp_matches(substr(any_value(value), CAST(min(pos) AS INTEGER) + 1, CAST(max(pos) - min(pos) AS INTEGER) + {WINDOW}), '[0-9]')
    ), every AS (
      SELECT * FROM base
      UNION ALL SELECT rid, 3, 'entropy', start, stop FROM high h
      WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = h.rid AND b.start <= h.start AND b.stop >= h.stop)
    ), told AS (
      SELECT rid, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS c, count(*) FILTER (rank = 2) AS h,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans
      FROM every GROUP BY rid
    )
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM numbered LEFT JOIN told USING (rid)"""


QUERIES = {"op9_secret_scan": op9_secret_scan}
ORACLES = {"op9_secret_scan": _oracle()}
