"""The language of a short text and the language a prompt asks for."""

from __future__ import annotations

import re

# Frequent function words of the four languages.
FUNCTION_WORDS = {
    "en": "the of and to in is a an for with on from as by that this it are be at or which has have its not we one into two each show draw create please make use include place link leads link connect runs",
    "de": "der die das und ist ein eine einen im in zu von mit auf für den dem des nicht als auch sich es wird an bei dass aus wir eine zwei bitte zeichne erstelle zeige setze verwende führt verbinde wie",
    "fr": "le la les des du de et un une est en dans pour que qui sur par au aux pas ce cette avec plus il nous deux sans dessine crée merci voici place utilise mène relie comment sont l d",
    "es": "el la los las de del y un una es en para que por con se no al lo como más su sus esta este son dos sin dibuja crea muestra usa coloca lleva conecta desde hay",
}
# Names of the languages in the four languages.
LANGUAGE_NAMES = {
    "en": ["english", "englisch", "anglais", "inglés", "ingles"],
    "de": ["german", "deutsch", "allemand", "alemán", "aleman"],
    "fr": ["french", "französisch", "franzoesisch", "français", "francais", "francés", "frances"],
    "es": ["spanish", "spanisch", "espagnol", "español", "espanol"],
}
# Words that tell that a sentence is about the language of the labels.
_ABOUT_LABELS = re.compile(
    r"label|caption|wording|written|write|read|text|annotat|beschrift|leser|lesen|schreib|étiquet|lecteur|lisent|légend|libell|écri|etiquet|rotul|rótul|público|lector|lee|escri"
)
_SETS = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}
_NAMED = [(lang, re.compile(r"\b(?:" + "|".join(names) + r")(?:e[nrms]?)?\b")) for lang, names in LANGUAGE_NAMES.items()]
_WORDS = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?:;])\s+|\n+")


def language_of(text: str) -> str:
    """The language with most function words, en on ties and for no text."""
    words = _WORDS.findall(text.lower())
    best, most = "en", 0
    for lang, known in _SETS.items():
        hits = sum(w in known for w in words)
        if hits > most:
            best, most = lang, hits
    return best


def asked_language(prompt: str) -> str:
    """The language in which the prompt wants its labels: the one it names for them, else its own."""
    low = prompt.lower()
    sentences = _SENTENCE.split(low)
    for at, sentence in enumerate(sentences):
        for lang, names in _NAMED:
            if names.search(sentence):
                around = sentence if at == 0 else sentences[at - 1] + " " + sentence
                if _ABOUT_LABELS.search(around):
                    return lang
    return language_of(prompt)
