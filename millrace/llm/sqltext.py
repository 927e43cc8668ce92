"""SQL fragments for DuckDB that several operators' queries share."""

from __future__ import annotations

#: The CRC-32 remainders of the sixteen half bytes (polynomial 0xEDB88320).
CRC_NIBBLES = (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
)


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text expression: half byte by half byte, the lower one first."""
    table = f"[{', '.join(map(str, CRC_NIBBLES))}]::UBIGINT[]"
    halves = f"regexp_extract_all(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '.')"
    values = f"list_transform({halves}, lambda h: (strpos('0123456789ABCDEF', h) - 1)::UBIGINT)"
    step = f"xor(c >> 4, ({table})[(xor(c, x) & 15)::BIGINT + 1])"
    return f"xor(list_reduce({values}, lambda c, x: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)::BIGINT"
