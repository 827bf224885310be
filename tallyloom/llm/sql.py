"""Pieces of DuckDB SQL that several queries share."""

#: One row ``t``: the 256 entries of the table of CRC-32, from its polynomial.
CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
                  lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i))"""


def crc32(text: str) -> str:
    """Checksum of a text of code points below 0x800; ``t`` must be in scope."""
    bytes_ = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN c = '' THEN CAST([] AS BIGINT[]) WHEN unicode(c) < 128 "
              "THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))")
    step = "lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), {step}), 4294967295)"
