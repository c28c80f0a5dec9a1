"""Call traces as text: lines cut into their top calls, traces into flat calls, without a nesting parser.

A scan over brackets and strings keeps its own stack, so nesting has no limit and the work grows with the
length of the text. Memory is that of one trace.
"""

from __future__ import annotations

import json
import re

_STRING = r'"(?:[^"\\]|\\.)*"'
_BRACKETS = re.compile(rf"{_STRING}|[{{}}\[\]]", re.S)
_PARTS = re.compile(rf"{_STRING}|[{{}}\[\],]", re.S)
_COLON = re.compile(r"\s*:\s*")
_CLOSING = {"{": "}", "[": "]"}
_LONG = range(-(1 << 63), 1 << 63)


def _object(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def flat_calls(text: str) -> list[tuple[int | None, str]] | None:
    """(parent, own fields) of every call of a trace, depth first; the parent is a place in the list.

    The fields are JSON text with null in place of the inner calls. None if the text is no JSON object.
    """
    found: list[tuple[int | None, str]] = []
    stack: list[str] = []           # open containers: "call", "calls" or their bracket
    own: list[tuple[int, list[str]]] = []
    start = end = 0
    list_at = -1
    for token in _BRACKETS.finditer(text):
        sign, at = token[0], token.start()
        top = stack[-1] if stack else None
        if sign in _CLOSING:
            if top == "call" and at == list_at:
                own[-1][1].append(text[start:at] + "null")
                stack.append("calls")
            elif top == "calls" or top is None:
                if sign != "{" or top is None and found:
                    return None
                found.append((own[-1][0] if own else None, ""))
                own.append((len(found) - 1, []))
                stack.append("call")
                start = at
            else:
                stack.append(sign)
        elif sign in "}]":
            if top is None or sign != ("]" if top == "calls" else "}" if top == "call" else _CLOSING[top]):
                return None
            stack.pop()
            if top == "call":
                place, pieces = own.pop()
                flat = "".join(pieces) + text[start:token.end()]
                if _object(flat) is None:
                    return None
                found[place] = (found[place][0], flat)
                end = token.end()
            elif top == "calls":
                start = token.end()
        elif top == "call" and sign == '"calls"':
            colon = _COLON.match(text, token.end())
            if colon and text.startswith("[", colon.end()):
                list_at = colon.end()
    if stack or not found or text[:text.index("{")].strip() or text[end:].strip():
        return None
    return found


def split_line(line: str | None) -> tuple[int, list[str | None]] | None:
    """(block number, texts of the top calls) of a trace line; None if any part of it does not decode."""
    parts: list[str | None] = []
    stack: list[str] = []
    result: tuple[int, int] | None = None
    result_at = begin = -1
    for token in _PARTS.finditer(line or ""):
        sign, at = token[0], token.start()
        if sign in _CLOSING:
            stack.append(sign)
            if at == result_at:
                parts, begin = [], token.end()
        elif sign in "}]":
            if not stack or _CLOSING[stack.pop()] != sign:
                return None
            if begin >= 0 and len(stack) == 1:
                last = line[begin:at].strip()
                if last or parts:
                    parts.append(last)
                result, begin = (result_at, token.end()), -1
        elif sign == ",":
            if begin >= 0 and len(stack) == 2:
                parts.append(line[begin:at].strip())
                begin = token.end()
        elif sign == '"result"' and len(stack) == 1:
            colon = _COLON.match(line, token.end())
            if colon and line.startswith("[", colon.end()):
                result_at = colon.end()
    if stack or result is None:
        return None
    rest = _object(line[:result[0]] + "null" + line[result[1]:])
    number = rest.get("blockNumber") if rest else None
    if type(number) is not int or number not in _LONG:
        return None
    tops = [None if part == "null" else part for part in parts]
    return None if any(top is not None and flat_calls(top) is None for top in tops) else (number, tops)
