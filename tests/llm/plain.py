"""The operators' results in plain Python, from their definitions, without any index."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def grams(found: list[str], size: int) -> list[tuple[str, ...]]:
    return [tuple(found[i : i + size]) for i in range(len(found) - size + 1)]


def shingles(text: str | None, size: int) -> frozenset:
    found = words(text, lower=True)
    return frozenset(grams(found, min(size, len(found)))) if found else frozenset()


def components(docs: list[tuple], size: int, percent: int) -> dict:
    """doc_id: (shingles, smallest id reachable), every pair compared through its shingles."""
    sets = {i: shingles(text, size) for i, text in docs}
    holders = defaultdict(list)
    for i, own in sets.items():
        for one in own:
            holders[one].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in sets.items():
        for j, shared in Counter(j for one in own for j in holders[one] if j < i).items():
            if 100 * shared >= percent * (len(own) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(own), find(i)) for i, own in sets.items()}


def quality(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    windows = Counter(grams(found, 3))
    repeated = {i + k for i, one in enumerate(grams(found, 3)) if windows[one] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(repeated)


def kept_words(docs: list[tuple]) -> dict:
    """doc_id: (words, removed, digest of the rest)."""
    found = sorted((i, words(text)) for i, text in docs)
    first: dict = {}
    for i, own in found:
        for one in grams(own, 13):
            first.setdefault(one, i)
    result = {}
    for i, own in found:
        gone = {p + k for p, one in enumerate(grams(own, 13)) if first[one] < i for k in range(13)}
        result[i] = (len(own), len(gone), sha(" ".join(w for p, w in enumerate(own) if p not in gone)))
    return result


def _luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    """Base spans (kind, start, end), by kind and then place."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and _luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [
        (kind, m.start(), m.end()) for kind, rule, passes in rules for m in re.finditer(rule, text or "") if passes(m.group())
    ]


def leaks(docs: list[tuple], items: list[tuple], size: int = 5, percent: int = 80) -> set:
    wanted = {i: shingles(text, size) for i, text in items}
    found = set()
    for d, text in docs:
        own = words(text, lower=True)
        by_width = {w: set(grams(own, w)) for w in range(1, size + 1)}
        for i, want in wanted.items():
            if want:
                shared = len(want & by_width[len(next(iter(want)))])
                if 100 * shared >= percent * len(want):
                    found.add((d, i, len(want), shared))
    return found


def article(page: str | None) -> str:
    """Text of the article element of the given pages, whose only inline element is b."""
    inside = (page or "").partition("<article>")[2].partition("</article>")[0]
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inside))).split())


def canonical(url: str | None) -> str:
    rest = re.sub(r"(?s)#.*$", "", re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*://", "", url or ""))
    host, path, query = re.match(r"(?s)([^/?]*)([^?]*)\??(.*)", rest).groups()
    host = re.sub(r":(80|443)$", "", re.sub(r"^www\.", "", host.lower()))
    kept = sorted(q for q in query.split("&") if q and not re.fullmatch(r"(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?", q))
    return host + re.sub("/+$", "", path) + ("?" + "&".join(kept) if kept else "")


def revisits(pages: list[tuple]) -> dict:
    """page_id: (canonical url, outcome, source page) of the crawl that ``captures_of`` makes."""
    by_url = defaultdict(list)
    for i, url, body in pages:
        by_url[canonical(url)].append((i * 60, i, body or ""))
    result = {}
    for i, url, body in pages:
        earlier = [one for one in by_url[canonical(url)] if canonical(url) and one[0] < i * 60 + 60_030]
        last = max(earlier, default=None)
        outcome = "unresolved" if last is None else "resolved" if last[2] == (body or "") else "mismatch"
        result[i] = (canonical(url), outcome, last[1] if outcome == "resolved" else None)
    return result


URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def ruled(url: str | None) -> tuple:
    """host, path, rule, verdict (None where no rule fits)."""
    if not url or "://" not in url:
        return "", "", None, None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.partition("://")[2]).groups()
    host = host.translate(LOWER)
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def conversation(turns: list[tuple]) -> tuple:
    """n_turns, turns digest, loss characters, loss digest, from (turn, role, text)."""
    ordered = sorted((t is not None, t or 0, r or "", x or "") for t, r, x in turns)
    loss = "".join(x for *_, r, x in ordered if r == "assistant")
    return len(ordered), sha("".join(f"{r}\n{x}\n" for *_, r, x in ordered)), len(loss), sha(loss)


def template_tree(paths: list[tuple]) -> dict:
    """(host, segments): (template, purity) from (host, segments, labelled, bad), level by level over all paths."""
    smoothing, similar = 10.0, 1.96
    n, b = sum(p[2] for p in paths), sum(p[3] for p in paths)
    overall = b / n if n else 0.0
    state = {}
    for host in {p[0] for p in paths}:
        mine = [p for p in paths if p[0] == host]
        purity = (sum(p[3] for p in mine) + smoothing * overall) / (sum(p[2] for p in mine) + smoothing)
        state |= {(host, p[1]): ("", purity, p[2], p[3]) for p in mine}
    for level in range(max((len(p[1]) for p in paths), default=0)):
        groups = defaultdict(list)
        for (host, segments), (template, *_) in state.items():
            if len(segments) >= level and template.count("/") == level:
                groups[host, template].append((host, segments))
        for (_, template), members in groups.items():
            branches = defaultdict(list)
            for key in members:
                branches[key[1][level] if len(key[1]) > level else ""].append(key)
            all_n, all_b = (sum(state[k][i] for k in members) for i in (2, 3))
            share = all_b / all_n if all_n else 0.0
            nodes = defaultdict(list)
            for segment, keys in branches.items():
                bn, bb = (sum(state[k][i] for k in keys) for i in (2, 3))
                like = segment and abs(bb - bn * share) <= similar * (bn * share * (1 - share)) ** 0.5
                nodes["*" if like else segment] += keys
            for branch, keys in nodes.items():
                if branch:
                    purity = (sum(state[k][3] for k in keys) + smoothing * state[keys[0]][1]) / (sum(state[k][2] for k in keys) + smoothing)
                    for k in keys:
                        state[k] = (f"{template}/{branch}", purity, *state[k][2:])
    return {key: value[:2] for key, value in state.items()}
