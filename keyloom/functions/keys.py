"""Column expressions on keys: scope, patterns, renaming, expiry and slots."""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

CORE_TYPES = ("string", "hash", "list", "set", "zset", "stream")


def _any(tests: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, tests, F.lit(False))


def allows_key(key: Column, deny: list[str] = (), only: list[str] = ()) -> Column:
    """Prefix scope: no denied prefix, and one of ``only`` if there are any. Works on strings and on bytes."""
    fits = lambda p: F.startswith(key, F.lit(p))
    allowed = ~_any([fits(p) for p in deny])
    return allowed & _any([fits(p) for p in only]) if only else allowed


#: Other names that type lists may use.
TYPE_ALIASES = {
    "json": "ReJSON-RL", "topk": "TopK-TYPE", "sortedset": "zset", "streams": "stream", "strings": "string", "hashes": "hash",
    "lists": "list", "sets": "set", "bloom": "MBbloom--", "cuckoofilter": "MBbloomCF", "cf": "MBbloomCF", "cms": "CMSk-TYPE",
}
ALL_TYPES = (*CORE_TYPES, "ReJSON-RL", "MBbloom--", "MBbloomCF", "CMSk-TYPE", "TSDB-TYPE", "TDIS-TYPE", "graphdata", "vectorset")


def resolve_types(types: list[str] = (), disallow: list[str] = (), exact_top_k: bool = False, same_engine: bool = False) -> list[str]:
    """The real type names of a type list: aliases, ``all``, types that modes add, less the disallowed ones.

    An empty list stands for all; an empty outcome is an error.
    """
    real = lambda t: TYPE_ALIASES.get(t.strip().lower(), t.strip())
    asked = [real(t) for t in types if t.strip()]
    chosen = list(ALL_TYPES) if not asked or any(t.lower() == "all" for t in asked) else asked
    chosen += ["TopK-TYPE"] if exact_top_k else []
    chosen += ["TopK-TYPE", "MBbloom--", "CMSk-TYPE"] if same_engine else []
    drop = {real(t).lower() for t in disallow}
    out = list({t.lower(): t for t in chosen if t.lower() not in drop}.values())
    if not out:
        raise ValueError("the type list leaves no type to carry")
    return out


def allows_type(kind: Column, types: list[str] = ()) -> Column:
    """Type filter without regard to case; an empty list allows all."""
    return F.lower(kind).isin(*(t.lower() for t in types)) if types else F.lit(True)


def glob_to_regex(glob: str) -> str:
    """A key pattern (* ? [..] and backslash escapes) as a regular expression; an unclosed [ is itself.

    In a class only a leading ^, ranges and backslashes mean something; an empty one fits nothing.
    """
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        if c == "[" and (close := glob.find("]", i + 1)) > 0:
            inner = glob[i + 1 : close]
            negated, inner = inner[:1] == "^", inner[inner[:1] == "^" :]
            listed = re.sub(r"\\(.)|([\[\]&^~|#\\])", lambda m: re.escape(m[1]) if m[1] else "\\" + m[2], inner)
            out.append(f"[{'^' * negated}{listed}]" if listed else "." if negated else "(?!)")
            i = close
        elif c == "\\":
            i += 1
            out.append(re.escape(glob[i : i + 1]))
        else:
            out.append({"*": ".*", "?": "."}.get(c) or re.escape(c))
        i += 1
    return rf"(?s)\A{''.join(out)}\z"


def glob_match(key: Column, glob: str) -> Column:
    return F.lit(True) if glob == "*" else key.rlike(glob_to_regex(glob))


def not_volatile(ttl_ms: Column, below_ms: int = 1000) -> Column:
    """False for keys about to expire: 0 <= ttl < below."""
    return ~F.coalesce((ttl_ms >= 0) & (ttl_ms < below_ms), F.lit(False))


@dataclass(frozen=True)
class KeyNames:
    """Renaming of keys between the sides: prefix rules old -> new, then an outer prefix.

    The longest old prefix that fits wins. A key that no rule renames, but that stands where renamed
    keys land, has no target name (null), so every target name has one source name.
    """

    rules: tuple[tuple[str, str], ...] = ()
    outer: str = ""

    @staticmethod
    def parse(text: str | None = None, prefix: str = "", separator: str = "") -> KeyNames:
        """From ``old=new,old=new``; refuses parts that are not old=new, empty or overlapping new prefixes and repeated old ones."""
        rules: list[tuple[str, str]] = []
        for part in filter(str.strip, (text or "").split(",")):
            old, eq, new = (x.strip() for x in part.partition("="))
            if not eq:
                raise ValueError(f"'{part.strip()}' is not old=new")
            if not new:
                raise ValueError(f"'{part.strip()}' has no new prefix")
            rules.append((old, new))
        olds, news = [o for o, _ in rules], [n for _, n in rules]
        if len(set(olds)) < len(olds):
            raise ValueError("an old prefix appears twice")
        if any(i != j and b.startswith(a) for i, a in enumerate(news) for j, b in enumerate(news)):
            raise ValueError("new prefixes overlap, so a target key could come from either rule")
        return KeyNames(tuple(sorted(rules, key=lambda r: -len(r[0]))), prefix + separator if prefix else "")

    @staticmethod
    def _after(key: Column, prefix: str) -> Column:
        """What follows a prefix: positions count characters of strings and bytes of binary keys."""
        at = F.when(F.typeof(key) == "binary", len(prefix.encode())).otherwise(len(prefix)) + 1
        return F.substring(key, at, F.length(key))

    def to_target(self, key: Column) -> Column:
        name = None
        for old, new in self.rules:
            moved = F.concat(F.lit(new), self._after(key, old))
            name = (F if name is None else name).when(key.startswith(old), moved)
        landed = _any([key.startswith(new) for _, new in self.rules])
        name = F.when(~landed, key) if name is None else name.when(~landed, key)
        return F.concat(F.lit(self.outer), name) if self.outer else name

    def to_source(self, key: Column) -> Column:
        """The source name that maps to a target name; null when none does."""
        bare = F.when(key.startswith(self.outer), self._after(key, self.outer))
        source = None
        for old, new in self.rules:
            back = F.concat(F.lit(old), self._after(bare, new))
            source = (F if source is None else source).when(bare.startswith(new), back)
        source = bare if source is None else source.otherwise(bare)
        return F.when(self.to_target(source) == key, source)

    def target_prefixes(self, prefix: str) -> list[str]:
        """The target prefixes that hold every key under a source prefix."""
        own = next((new + prefix[len(old) :] for old, new in self.rules if prefix.startswith(old)), prefix)
        covered = [new for old, new in self.rules if old.startswith(prefix) and len(old) > len(prefix)]
        return list(dict.fromkeys(self.outer + p for p in (own, *covered)))


def effective_ttl(ttl_ms: Column, strategy: str = "PRESERVE", offset_ms: int = 0) -> Column:
    """Expiry that the target gets, null for none: PRESERVE keeps it, STRIP drops it, RESET adds the offset."""
    if strategy == "STRIP":
        return F.lit(None).cast("long")
    kept = F.when(ttl_ms > 0, ttl_ms)
    if strategy == "RESET":
        moved = F.coalesce(kept, F.lit(0)) + offset_ms
        return F.when(moved > 0, moved).cast("long")
    return kept.cast("long")


def remaining_ttl(ttl_ms: Column, read_at_ms: Column, now_ms: Column) -> Column:
    """A TTL aged from when it was read, never below 1; without a positive TTL or a read time as it is."""
    aged = F.greatest(F.lit(1).cast("long"), ttl_ms - (now_ms - read_at_ms))
    return F.when((ttl_ms > 0) & read_at_ms.isNotNull(), aged).otherwise(ttl_ms)


def hash_tag(key: Column) -> Column:
    """The part of a key that decides its slot: inside the first {..} if that is not empty, else all of it."""
    tag = F.regexp_extract(key, r"^[^{]*\{([^}]+)\}", 1)
    return F.when(tag != "", tag).otherwise(key)


def slot_of(key: Column, slots: int = 16384) -> Column:
    """CRC16 (XMODEM) of the key's tag modulo the number of slots, bit by bit over its bytes."""
    hexed = F.hex(F.encode(hash_tag(key), "UTF-8"))
    byte = lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def shift(crc: Column, _: Column) -> Column:
        moved = F.shiftleft(crc, 1)
        return F.when(crc.bitwiseAND(0x8000) != 0, moved.bitwiseXOR(0x1021)).otherwise(moved).bitwiseAND(0xFFFF)

    eight = F.array(*(F.lit(0) for _ in range(8)))
    crc = F.aggregate(
        F.when(F.length(hexed) > 0, F.sequence(F.lit(0), (F.length(hexed) / 2 - 1).cast("int"))).otherwise(F.array().cast("array<int>")),
        F.lit(0), lambda a, i: F.aggregate(eight, a.bitwiseXOR(F.shiftleft(byte(i), 8)), shift),
    )
    return crc % slots
