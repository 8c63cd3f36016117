"""Made-up texts for the tests of this folder."""

WORDS = [f"w{i}x{i * 7 % 13}" for i in range(400)]


def words(seed: int, n: int) -> list[str]:
    """Words of a made-up text, another for each seed."""
    out, x = [], seed * 2654435761 % 2**32
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return out
