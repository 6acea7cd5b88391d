"""Features of a prompt and one of its targets for a linear classifier."""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter

from corvane.llm.languages import asked_language

#: Places for hashed n-grams of labels, for those of speech and endings, and for pair features.
LABELS = 1 << 15
SPEECH = 1 << 14
PAIR = 220
WIDTH = LABELS + SPEECH + PAIR
#: First words of a running text looked at together, and of the longest label in a drawing.
FIRST, FIRST_OF_LABEL = 120, 60
#: Words looked at together in longer texts, all through, as long as a refusal is.
WINDOW = 24

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W_]+")
_COMMENT = re.compile(r"<!--(.*?)(?:-->|$)", re.S)
_ASIDE = re.compile(r"<(desc|metadata|style)\b[^>]*>(.*?)</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*(?:>|$)")
_VISIBLE = re.compile(r"<\s*(?:rect|circle|ellipse|line|polyline|polygon|path|image|use)\b", re.I)
_TEXT_TAG = re.compile(r"<\s*text\b", re.I)
_LABEL = re.compile(r'"(?:label|title|text|name|note)"\s*:\s*"((?:[^"\\]|\\.)*)"', re.I)
_FENCE = re.compile(r"^\s*```\w*\s*|\s*```\s*$")
_NODE = re.compile(r'"kind"\s*:', re.I)


def looks_like(text: str) -> str:
    """svg, ir or bare."""
    start = text.lstrip()[:1]
    if start in ("{", "["):
        return "ir"
    return "svg" if start == "<" else "bare"


def _pieces(text: str, form: str) -> tuple[list[str], list[str], int, bool]:
    """Visible texts, comments, drawn elements, whether the text is whole."""
    if form == "svg":
        comments = _COMMENT.findall(text)
        body = _ASIDE.sub(" ", _COMMENT.sub(" ", text))
        shapes = len(_VISIBLE.findall(body))
        texts = [t for t in (html.unescape(x).strip() for x in _TAG.split(body)) if t]
        end = text.rstrip().lower()
        whole = end.endswith("</svg>") or (end.endswith(("/>", "-->")) and end.count("<") == end.count(">") and "<svg" not in _COMMENT.sub(" ", end).replace("<svg/>", ""))
        return texts, comments, shapes, whole
    if form == "ir":
        texts = []
        try:
            json.loads(text)
            whole = True
        except (ValueError, RecursionError):
            whole = False
        for raw in _LABEL.findall(text):
            if "\\" in raw:
                try:
                    raw = json.loads('"' + raw + '"')
                except ValueError:
                    pass
            if raw.strip():
                texts.append(raw)
        return texts, [], len(_NODE.findall(text)), whole
    return [text], [], 0, True


def _windows(words: list[str], first: int) -> tuple[list[str], list[list[str]]]:
    """The first words, and windows over all of them if there are more."""
    half = WINDOW // 2
    return words[:first], [words[at : at + WINDOW] for at in range(0, max(1, len(words) - half), half)] if len(words) > first else []


def _own(spoken: list[str], asked: set[str]) -> list[str]:
    """The words with one mark for each run of words of the prompt: what is drawn is no evidence of how it is spoken of."""
    out: list[str] = []
    for word in spoken:
        if word not in asked:
            out.append(word)
        elif not out or out[-1] != "*":
            out.append("*")
    return out


def _speech(spoken: list[str]) -> tuple[list[int], list[float]]:
    places: set[int] = set()
    for a, b in zip(spoken, [*spoken[1:], "$"], strict=False):
        places.add(LABELS + zlib.crc32(f"w|{a}".encode()) % SPEECH)
        places.add(LABELS + zlib.crc32(f"b|{a}|{b}".encode()) % SPEECH)
        if len(a) > 5:
            places.add(LABELS + zlib.crc32(f"s|{a[:5]}".encode()) % SPEECH)
    return list(places), [len(places) ** -0.5] * len(places)


class Features:
    """Turns (prompt, target) into places of the feature vector; remembers words."""

    def __init__(self):
        self._words: dict[tuple[str, str], list[int]] = {}

    def _of(self, mark: str, word: str) -> list[int]:
        key = (mark, word)
        found = self._words.get(key)
        if found is None:
            if len(self._words) > 300_000:
                self._words.clear()
            padded = f"^{word}$"
            grams = [word] + [padded[i : i + 3] + "_" for i in range(len(padded) - 2)]
            found = self._words[key] = [zlib.crc32(f"{mark}|{g}".encode()) % LABELS for g in grams]
        return found

    def __call__(self, prompt: str, target: str) -> tuple[tuple[list[int], list[float]], list[tuple[list[int], list[float]]]] | None:
        """Places and values of the features but speech, and those of speech by window; None for a blank target.

        The first window holds the comments and the first words; where there are more, small
        windows that overlap by half follow over all of the text, so what is said late counts
        as well. Each kind of n-gram has unit length, in each window.
        """
        if not target or not target.strip():
            return None
        text = _FENCE.sub("", _FENCE.sub("", target))
        form = looks_like(text)
        texts, comments, shapes, whole = _pieces(text, form)
        lang = asked_language(prompt)
        label: set[int] = set()
        if shapes:  # language matters only where labels are
            for word in {w for t in texts for w in _WORD.findall(t.lower())}:
                label.update(self._of("L" + lang, word))
        said = _WORD.findall(" ".join(comments).lower())
        longest = max(texts, key=len, default="")
        if shapes < 2:
            head, windows = _windows([w for t in texts for w in _WORD.findall(t.lower())], FIRST)
        else:
            long = sorted((t for t in dict.fromkeys(texts) if len(t) > 40), key=len, reverse=True)
            head, windows = _windows(_WORD.findall(long[0].lower()) if long else [], FIRST_OF_LABEL)
            windows += [part for t in long[1:] for part in _windows(_WORD.findall(t.lower()), 0)[1]]
        asked = set(_WORD.findall(prompt.lower()))
        windows = [_own(spoken, asked) for spoken in (said + head, *windows)]
        pair = self._pair(prompt, text, form, texts, comments, shapes, whole, longest)
        base = [*label, *pair], [max(1, len(label)) ** -0.5] * len(label) + [0.3] * len(pair)
        return base, [_speech(spoken) for spoken in windows if spoken]

    @staticmethod
    def _pair(prompt, text, form, texts, comments, shapes, whole, longest) -> list[int]:
        on = [0]
        base = {"svg": 1, "ir": 2, "bare": 3}[form]
        on.append(base)
        on.append((216 if whole and not comments else 4) + min(shapes, 3))
        if shapes == 0:
            on.append(80 + base)
        words = sum(len(_TOKEN.findall(t)) for t in texts)
        on.append(8 + (0 if words == 0 else 1 if words < 3 else 2 if words < 8 else 3 if words < 25 else 4))
        nothing = shapes == 0 and words == 0
        on.append(13 + int(nothing) + 2 * int(nothing and not comments))
        on.append(17 + int(not whole) + 2 * (base - 1))
        end = text.rstrip()
        on.append(23 + int(end.endswith(("...", "…"))))
        said = " ".join(comments)
        on.append(25 + (0 if not said.strip() else 1 if shapes == 0 else 2))
        # a stand-in for nothing: hardly a word, no drawing
        on.append(28 + int(shapes == 0 and words <= 2 and len("".join(texts)) <= 16))
        a = Counter(_TOKEN.findall(prompt.lower()))
        size = max(1, sum(a.values()))
        best, cover = 0.0, 0.0
        for piece in {longest, *([said] if said else []), *([" ".join(texts)] if shapes < 2 else [])}:
            b = Counter(_TOKEN.findall(piece.lower()))
            total = sum(b.values())
            if total < 6:
                continue
            common = sum((a & b).values())
            best, cover = max(best, 2 * common / (size + total)), max(cover, common / total)
        if shapes > 1:  # how much of what the prompt names is drawn, with a comment beside it or without
            drawn = len(a.keys() & {w for t in texts for w in _TOKEN.findall(t.lower())}) / max(1, len(a))
            on.append(196 + 10 * bool(said.strip()) + min(9, int(drawn * 10)))
        on.append(30 + min(9, int(best * 10)))
        on.append(40 + min(9, int(cover * 10)))
        if shapes < 2:
            # hardly a drawing: how much is said and how far it is the prompt, looked at together
            on.append(96 + 50 * min(shapes, 1) + 10 * (0 if words == 0 else 1 if words < 3 else 2 if words < 8 else 3 if words < 25 else 4) + min(9, int(best * 10)))
            on += [50 + min(9, int(best * 10)), 60 + min(9, int(cover * 10)), 70 + min(4, len(longest) // 30)]
        else:
            on.append(75 + min(4, len(longest) // 40))
        return [LABELS + SPEECH + k for k in on]
