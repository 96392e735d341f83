"""Text templates: fills {…}, optional parts <…> (which may hold others), guidance […]; compiled to patterns
and heading forms."""

from __future__ import annotations

import re
from itertools import product

FILL = 300
_MARKS = {"{": "}", "<": ">", "[": "]"}
_KINDS = {"{": "fill", "<": "optional", "[": "guidance"}


def parse(template: str) -> list[tuple]:
    """(kind, text) parts, and ("optional", parts): fill, guidance, text or optional."""
    stack: list[tuple[str, list]] = [("", [])]
    at = 0
    while at < len(template):
        c = template[at]
        if c == "<":
            stack.append((c, []))
        elif c == ">" and stack[-1][0] == "<":
            _, inner = stack.pop()
            stack[-1][1].append(("optional", inner))
        elif c in "{[":
            end = template.find(_MARKS[c], at)
            if end < 0:
                raise ValueError(f"unbalanced mark at {at}")
            stack[-1][1].append((_KINDS[c], template[at + 1 : end]))
            at = end
        elif c in "}]>":
            raise ValueError(f"unbalanced mark at {at}")
        else:
            end = next((i for i in range(at, len(template)) if template[i] in "{}<>[]"), len(template))
            stack[-1][1].append(("text", template[at:end]))
            at = end - 1
        at += 1
    if len(stack) > 1:
        raise ValueError("an optional part does not end")
    return stack[0][1]


def _literal(t: str) -> str:
    """Any white space between words; a plural mark (s) may be there, spelled out, or be absent."""
    words = (re.escape(w).replace(r"\(s\)", r"(?:\(s\)|s)?") for w in re.split(r"\s+", t))
    return r"\s+".join(words)


def _compiled(parts: list[tuple]) -> str:
    made = {"fill": lambda t: "(?s:.{1,%d}?)" % FILL, "optional": lambda p: f"(?:{_compiled(p)})?", "guidance": lambda t: "", "text": _literal}
    return "".join(made[k](t) for k, t in parts)


def pattern(template: str) -> str:
    """A pattern for Java and Python. The first letter of the required text may be of either case."""
    parts = parse(template)
    lead = next((i for i, (k, _) in enumerate(parts) if k != "optional"), None)
    if lead is not None and parts[lead][0] == "text" and parts[lead][1][:1].isalpha():
        t = parts[lead][1]
        head = f"[{t[0].lower()}{t[0].upper()}]"
        return _compiled(parts[:lead]) + head + _literal(t[1:]) + _compiled(parts[lead + 1 :])
    return _compiled(parts)


def runs(template: str) -> list[str]:
    """The stretches of required text, cut at fills, optional parts and plural marks."""
    return [" ".join(r.split()) for k, t in parse(template) if k == "text" for r in t.split("(s)") if r.strip()]


def anchor(template: str) -> str:
    """The longest run of whole words that every match holds: a cheap test before the pattern runs. Words that
    touch a mark may go on behind it, so they do not count; the first letter's case is free, so neither does its word."""
    parts = parse(template)
    best = ""
    for n, (k, t) in enumerate(parts):
        if k != "text":
            continue
        for i, run in enumerate(t.split("(s)")):
            words = run.split()
            if words and (i or n == 0 or not run[:1].isspace()):
                words = words[1:]
            if words and (i < t.count("(s)") or (n + 1 < len(parts) and not run[-1:].isspace())):
                words = words[:-1]
            best = max(best, " ".join(words), key=len)
    return best


def forms(heading: str) -> list[str]:
    """All headings that a heading with optional parts stands for, white space collapsed."""

    def spread(parts: list[tuple]) -> list[str]:
        choices = [[t] if k == "text" else ["", *spread(t)] if k == "optional" else [""] for k, t in parts]
        return ["".join(c) for c in product(*choices)]

    return sorted({" ".join(f.split()) for f in spread(parse(heading))})
