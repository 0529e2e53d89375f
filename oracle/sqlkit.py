"""Small SQL snippets shared by the oracle fragments."""


def r(expr: str, digits: int) -> str:
    """Round on decimal digits, result double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, digits: int) -> str:
    return r(f"{div(a, b)} * 100", digits)


def avg(expr: str) -> str:
    return div(f"SUM({expr})", f"COUNT({expr})")


def money(expr: str) -> str:
    return f"TRY_CAST({expr} AS DECIMAL(18,2))"


def top(source: str, keys: str, column: str, name: str, count_nulls: bool) -> str:
    """Most frequent value per key, smallest value on ties."""
    where = "" if count_nulls else f"WHERE {column} IS NOT NULL"
    return f"""SELECT {keys}, v AS {name} FROM (
        SELECT {keys}, v, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY n DESC, v ASC NULLS FIRST) AS rn
        FROM (SELECT {keys}, {column} AS v, COUNT(*) AS n FROM {source} {where} GROUP BY ALL)
    ) WHERE rn = 1"""


def titled(text: str) -> str:
    """Every word with a capital; words end at blanks and at punctuation but the apostrophe."""
    ends = r'''\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-'''
    return f"""array_to_string(list_transform(regexp_extract_all({text}, '[^{ends}]*[{ends}]|[^{ends}]+$'),
        lambda w: UPPER(LEFT(w, 1)) || LOWER(SUBSTRING(w, 2))), '')"""


def fingerprint(text: str) -> str:
    """The warehouse's signed 64-bit hash of an ASCII text of 4 to 7 bytes, by unsigned 128-bit arithmetic."""
    wrap = "18446744073709551616::UHUGEINT"

    def word(at: str) -> str:
        return " + ".join(f"ascii(substr(t, ({at})::BIGINT + {i + 1}, 1))::UHUGEINT * {256**i}" for i in range(4))

    def times(a: str) -> str:
        return f"(({a})::UHUGEINT * m) % {wrap}"

    return f"""(SELECT CASE WHEN h >= 9223372036854775808 THEN (h::HUGEINT - 18446744073709551616)::BIGINT ELSE h::BIGINT END FROM (
        SELECT {times("xor(b, b // 140737488355328)")} AS h FROM (
        SELECT {times("xor(v, xor(a, a // 140737488355328))")} AS b, m FROM (
        SELECT {times("xor(u, v)")} AS a, v, m FROM (
        SELECT n + 8 * ({word("0")}) AS u, {word("n - 4")} AS v, 11160318154034397263::UHUGEINT + 2 * n AS m FROM (
        SELECT {text} AS t, LENGTH({text})::UHUGEINT AS n))))))"""
