"""The warehouse's 64-bit fingerprint of short texts, as one SQL expression.

A fingerprint is arithmetic modulo 2**64 on the text's bytes. Numbers here are signed and an overflow is an
error, so products are put together from 16-bit digits and sums from 32-bit halves. Every intermediate number
is bound once (``_let``); written out where it is used, the expression would multiply with every step. The
expression is put together as text, since some thousand nodes take seconds to build call by call.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The multipliers of the published hash function.
K0 = 0xC3A5C85C97CB3127
K2 = 0x9AE16A3B2F90404F
LONGEST = 16  # bytes; longer texts are hashed by other formulas

_NIBBLES = 0x0F0F0F0F0F0F0F0F
_SIGNED_K2 = f"{K2 - (1 << 64)}L"
_names = count()


def _let(value: str, use: Callable[[str], str]) -> str:
    """``use`` of the name of a value that is computed once."""
    name = f"v{next(_names)}"
    return f"transform(array({value}), {name} -> {use(name)})[0]"


def _right(a: str, bits: int) -> str:
    return f"shiftrightunsigned({a}, {bits})"


def _left(a: str, bits: int) -> str:
    return f"shiftleft({a}, {bits})"


def _digits(number: int) -> list[str]:
    return [f"{number >> 16 * i & 0xFFFF}L" for i in range(4)]


def _times(a: str, b: Sequence[str]) -> str:
    """a * b modulo 2**64; ``b`` as its four 16-bit digits, the lowest first."""

    def product(x: str) -> str:
        own = [f"({_right(x, 16 * i)} & 65535L)" for i in range(4)]
        digits, carried = [], "0L"
        for i in range(4):
            total = " + ".join([carried, *(f"{own[j]} * {b[i - j]}" for j in range(i + 1))])
            digits.append(_left(f"(({total}) & 65535L)", 16 * i))
            carried = _right(f"({total})", 16)
        return f"({' | '.join(digits)})"

    return _let(a, product)


def _plus(a: str, b: str) -> str:
    """a + b modulo 2**64."""

    def total(x: str, y: str) -> str:
        low = f"((({x}) & 4294967295L) + (({y}) & 4294967295L))"
        high = f"({_right(x, 32)} + {_right(y, 32)} + {_right(low, 32)})"
        return f"({_left(high, 32)} | ({low} & 4294967295L))"

    return _let(a, lambda x: _let(b, lambda y: total(x, y)))


def _folded(a: str) -> str:
    return _let(a, lambda x: f"({x} ^ {_right(x, 47)})")


def _turned(a: str, bits: int) -> str:
    return _let(a, lambda x: f"({_right(x, bits)} | {_left(x, 64 - bits)})")


def _mixed(u: str, v: str, by: Sequence[str]) -> str:
    def both(y: str) -> str:
        a = _folded(_times(f"({u} ^ {y})", by))
        return _times(_folded(_times(f"({y} ^ {a})", by)), by)

    return _let(v, both)


def _word(hexed: str, at: str, width: int) -> str:
    """The little-endian number in ``width`` bytes from ``at``, of a text in hexadecimal digits."""
    # reversing the digits turns the bytes around and swaps the digits of each byte, which are swapped back
    number = f"CAST(conv(reverse(substr({hexed}, CAST(2 * ({at}) + 1 AS INT), {2 * width})), 16, -10) AS BIGINT)"
    return _let(number, lambda x: f"({_left(f'({x} & {_NIBBLES}L)', 4)} | ({_right(x, 4)} & {_NIBBLES}L))")


def _of_hex(hexed: str, n: str) -> str:
    first = _digits(K2)
    by = [f"({first[0]} + 2 * {n})", *first[1:]]  # the lowest digit takes up twice the length without a carry

    ends = f"({_word(hexed, '0', 1)} + {_left(_word(hexed, f'shiftright({n}, 1)', 1), 8)})"
    last = f"({n} + {_left(_word(hexed, f'{n} - 1', 1), 2)})"
    few = _times(_folded(f"({_times(ends, first)} ^ {_times(last, _digits(K0))})"), first)
    some = _mixed(f"({n} + {_left(_word(hexed, '0', 4), 3)})", _word(hexed, f"{n} - 4", 4), by)

    def halves(a: str, b: str) -> str:
        return _mixed(_plus(_times(_turned(b, 37), by), a), _times(_plus(_turned(a, 25), b), by), by)

    begin = _plus(_word(hexed, "0", 8), _SIGNED_K2)
    many = _let(begin, lambda a: _let(_word(hexed, f"{n} - 8", 8), lambda b: halves(a, b)))
    return (
        f"CASE WHEN {n} = 0 THEN {_SIGNED_K2} WHEN {n} < 4 THEN {few} WHEN {n} < 8 THEN {some} WHEN {n} <= {LONGEST} THEN {many} "
        f"ELSE CAST(raise_error('fingerprint of a text of more than {LONGEST} bytes') AS BIGINT) END"
    )


def fingerprint(text: str) -> Column:
    """Signed 64-bit fingerprint of a text of at most 16 bytes in UTF-8; NULL stays NULL, a longer text is an error.

    ``text`` is a column's name or another SQL expression.
    """
    hashed = _let(f"hex(encode({text}, 'UTF-8'))", lambda h: _let(f"CAST(shiftright(length({h}), 1) AS BIGINT)", lambda n: _of_hex(h, n)))
    return F.expr(f"CASE WHEN ({text}) IS NOT NULL THEN {hashed} END")
