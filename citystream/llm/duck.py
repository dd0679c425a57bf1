"""Expressions for the SQL counterparts that DuckDB has no function for."""


def crc32(column: str) -> str:
    """The unsigned CRC-32 of a column's decimal text: its bytes and eight steps after each, folded."""
    steps = (f"flatten(list_transform(string_split(cast({column} as varchar), ''), "
             "lambda x: list_concat([(1000 + ascii(x))::ubigint], list_transform(range(8), lambda y: 0::ubigint))))")
    step = ("lambda acc, s: case when s >= 1000 then xor(acc, s - 1000) "
            "else xor(acc >> 1, case when acc % 2 = 1 then 3988292384::ubigint else 0::ubigint end) end")
    return f"xor(list_reduce(list_prepend(4294967295::ubigint, {steps}), {step}), 4294967295::ubigint)"
