"""Hash functions as SQL text for the oracle. Keys there are ASCII."""


def _bytes(k: str) -> str:
    return f"list_transform(range(1, strlen({k}) + 1), lambda i: ord(substr({k}, i::INT, 1))::BIGINT)"


def fnv_mod(k: str, n: int) -> str:
    return (
        f"(CASE WHEN {k} = '' OR {k} IS NULL THEN 0 ELSE list_reduce({_bytes(k)}, "
        f"lambda h, b: (xor(h, b) * 16777619) & 4294967295, 2166136261::BIGINT) % {n} END)::INT"
    )


def murmur_partition(k: str, n: int) -> str:
    m, mask = 0x5BD1E995, 4294967295

    def at(pos: str, scale: int) -> str:
        return f"ord(substr({k}, ({pos})::INT, 1))::BIGINT * {scale}"

    block = " + ".join(at(f"4 * i + {j + 1}", 256**j) for j in range(4))
    blocks = f"list_transform(range(0, strlen({k}) // 4), lambda i: {block})"
    mul = f"((b * {m}) & {mask})"
    mix = f"((xor({mul}, {mul} >> 24) * {m}) & {mask})"
    seeded = f"xor({0x9747B28C}::BIGINT, strlen({k})::BIGINT)"
    body = f"list_reduce({blocks}, lambda h, b: xor((h * {m}) & {mask}, {mix}), {seeded})"
    base = f"(strlen({k}) - strlen({k}) % 4)"
    tail = (
        f"(CASE WHEN strlen({k}) % 4 >= 3 THEN {at(base + ' + 3', 65536)} ELSE 0 END"
        f" + CASE WHEN strlen({k}) % 4 >= 2 THEN {at(base + ' + 2', 256)} ELSE 0 END"
        f" + CASE WHEN strlen({k}) % 4 >= 1 THEN {at(base + ' + 1', 1)} ELSE 0 END)"
    )
    tailed = f"list_reduce([{tail}], lambda h, t: CASE WHEN t = 0 THEN h ELSE (xor(h, t) * {m}) & {mask} END, {body})"
    s1 = f"list_reduce([{tailed}], lambda a, h: (xor(h, h >> 13) * {m}) & {mask}, 0::BIGINT)"
    s2 = f"list_reduce([{s1}], lambda a, h: xor(h, h >> 15), 0::BIGINT)"
    return f"(({s2} & 2147483647) % {n})::INT"
