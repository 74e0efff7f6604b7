"""Number words, letter names and token expansion for Catalan and Spanish, built by rule."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import product

#: Number words.
UNITS = {
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte veintiuno veintidós veintitrés veinticuatro veinticinco veintiséis veintisiete veintiocho veintinueve".split(),
    "ca": "zero u dos tres quatre cinc sis set vuit nou deu onze dotze tretze catorze quinze setze disset divuit dinou vint vint-i-u vint-i-dos vint-i-tres vint-i-quatre vint-i-cinc vint-i-sis vint-i-set vint-i-vuit vint-i-nou".split(),
}
TENS = {"es": "treinta cuarenta cincuenta sesenta setenta ochenta noventa".split(), "ca": "trenta quaranta cinquanta seixanta setanta vuitanta noranta".split()}
HUNDREDS_ES = "ciento doscientos trescientos cuatrocientos quinientos seiscientos setecientos ochocientos novecientos".split()
#: Names of letters, Greek letters, signs and currencies, abbreviations and ordinals.
LETTERS = {
    "es": {"A": "a", "B": "be", "C": "ce", "Ç": "ce cedilla", "D": "de", "E": "e", "F": "efe", "G": "ge", "H": "hache", "I": "i", "J": "jota", "K": "ca", "L": "ele", "M": "eme", "N": "ene", "O": "o", "P": "pe", "Q": "cu", "R": "erre", "S": "ese", "T": "te", "U": "u", "V": "uve", "W": "uve doble", "X": "equis", "Y": "y grega", "Z": "zeta"},
    "ca": {"A": "a", "B": "be", "C": "ce", "Ç": "ce trencada", "D": "de", "E": "e", "F": "efa", "G": "ge", "H": "hac", "I": "i", "J": "jota", "K": "ca", "L": "ela", "M": "ema", "N": "ena", "O": "o", "P": "pe", "Q": "cu", "R": "erra", "S": "essa", "T": "te", "U": "u", "V": "ve", "W": "ve doble", "X": "ics", "Y": "i grega", "Z": "zeta"},
}
GREEK = {
    "es": {"Α": "alfa", "Β": "beta", "Γ": "gamma", "Δ": "delta", "Ε": "épsilon", "Ζ": "dseta", "Η": "eta", "Θ": "zeta", "Ι": "iota", "Κ": "kappa", "Λ": "lambda", "Μ": "mi", "Ν": "ni", "Ξ": "xi", "Ο": "ómicron", "Π": "pi", "Ρ": "ro", "Σ": "sigma", "Τ": "tau", "Υ": "ípsilon", "Φ": "fi", "Χ": "ji", "Ψ": "psi", "Ω": "omega"},
    "ca": {"Α": "alfa", "Β": "beta", "Γ": "gamma", "Δ": "delta", "Ε": "èpsilon", "Ζ": "zeta", "Η": "eta", "Θ": "theta", "Ι": "iota", "Κ": "kappa", "Λ": "lambda", "Μ": "mi", "Ν": "ni", "Ξ": "ksi", "Ο": "òmicron", "Π": "pi", "Ρ": "ro", "Σ": "sigma", "Τ": "tau", "Υ": "ípsilon", "Φ": "fi", "Χ": "khi", "Ψ": "psi", "Ω": "omega"},
}
#: The small letters have the names of the capitals but for these.
GREEK_SMALL = {"es": {"φ": "phi", "χ": "chi"}, "ca": {}}
SIGNS = {
    "es": {"°": "grados", "+": "más", "=": "igual a", ">": "mayor que", "<": "menor que", "%": "por ciento", "ħ": "constante de Planck reducida", "µ": "micro", "𝜆": "Lambda", "∑": "sumatorio", "≈": "aproximadamente igual a", "≠": "distinto a", "≥": "mayor o igual a", "≤": "menor o igual a ", "∞": "infinito", "√": "raíz cuadrada", "²": "al cuadrado", "³": "al cubo", "×": "multiplicado por", "÷": "dividido por", "±": "más o menos", "∫": "integral", "∂": "derivativa parcial", "∇": "nabla", "≡": "congruente a", "≜": "definido como", "⁰": "superíndice zero", "ⁱ": "superíndice uno", "ⁿ": "superíndice ene", "⁻": "superíndice menos", "₀": "subíndice theta", "𝑓": "función efe", "𝑥": "equis", "ˣ": "equis"},
    "ca": {"°": "graus", "+": "més", "=": "igual a", "%": "per cent", ">": "major que", "<": "menor que", "ħ": "constant de Planck reduïda", "µ": "micro", "𝜆": "Lambda", "∑": "sumatori", "≈": "aproximadament igual a", "≠": "diferent de", "≥": "major o igual que", "≤": "menor o igual que ", "∞": "infinit", "√": "arrel quadrada", "²": "al quadrat", "³": "al cub", "×": "multiplicat per", "÷": "dividit per", "±": "més o menys", "∫": "integral", "∂": "derivativa parcial", "∇": "nabla", "≡": "congruent a", "≜": "definit com", "⁰": "superíndex zero", "ⁱ": "superíndex u", "ⁿ": "superíndex ena", "⁻": "superíndex menys", "₀": "subíndex theta", "𝑓": "funció efa", "𝑥": "ics", "ˣ": "ics"},
}
CURRENCY = {"es": {"€": "euros", "$": "dólares", "¥": "yenes", "£": "libras"}, "ca": {"€": "euros", "$": "dòlars", "¥": "iens", "£": "lliures"}}
POINT_COMMA = {"es": ("punto", "coma"), "ca": ("punt", "coma")}
ABBREVIATIONS = {
    "es": {"aprox": "aproximadamente", "aux": "auxiliar", "cm": "centímetro", "dr": "doctor", "dra": "doctora", "etc": "etcétera", "gr": "gramo", "gral": "general", "kg": "quilogramos", "km": "quilómetros", "km/h": "quilómetros por hora", "mph": "millas por hora", "mm": "milímetro", "núm": "número", "pex": "por ejemplo", "pag": "página", "prof": "profesor", "ref": "referencia", "s/n": "sin número", "vs": "versus", "sr": "señor", "sra": "señora", "srta": "señorita"},
    "ca": {"aprox": "aproximadament", "avda": "avinguda", "cm": "centímetre", "dr": "doctor", "dra": "doctora", "sr": "senyor", "sra": "senyora", "etc": "etcètera", "fr": "francès", "gr": "gram", "kg": "quilograms", "km": "quilòmetres", "km/h": "quilòmetres per hora", "mph": "milles per hora", "màx": "màxim", "mín": "mínim", "mm": "mil·límetre", "núm": "número", "num": "número", "pex": "per exemple", "pàg": "pàgina", "pl": "plaça", "prof": "professor", "ref": "referència", "trad": "traducció", "vs": "versus"},
}
ACRONYMS = {"psoe": "pe soe", "fnac": "efnac", "dgaia": "degaia", "psuc": "pe suc", "psan": "pe san"}
ORDINALS = {
    "es": {"℃": "grados Celsius", "℉": "grados Farenheit", "1o": "primero", "1ra": "primera", "1a": "primera", "2ndo": "segundo", "2nda": "segunda", "2o": "segundo", "2a": "segunda", "3o": "tercer", "3a": "tercera", "3ro": "tercer", "3ra": "tercera", "4o": "cuarto", "4a": "cuarta", "4to": "cuarto", "4ta": "cuarta", "5o": "quinto", "5a": "quinta", "1º": "primero", "1ª": "primera", "2º": "segundo", "2ª": "segunda", "3º": "tercero", "3ª": "tercera", "4º": "cuarto", "4ª": "cuarta", "5º": "quinto", "5ª": "quinta"},
    "ca": {"℃": "graus Celsius", "℉": "graus Farenheit", "1r": "primer", "1ra": "primera", "2n": "segon", "2na": "segona", "3r": "tercer", "3a": "tercera", "4t": "quart", "4ta": "quarta", "5è": "cinquè", "5ena": "cinquena", "1º": "primer", "1ª": "primera", "2º": "segon", "2ª": "segona", "3º": "tercer", "3ª": "tercera", "4º": "quart", "4ª": "quarta", "5º": "cinquè", "5ª": "cinquena"},
}
#: Roman numerals that are read as ordinals; those of other numbers from 11 to 99 are cardinals.
ROMAN_ORDINALS = {
    "es": {"ii": "segundo", "iii": "tercero", "iiii": "cuatro", "iv": "quarto", "vi": "sexto", "vii": "séptimo", "viii": "octavo", "ix": "noveno"},
    "ca": {"ii": "segon", "iii": "tercer", "iiii": "quatre", "iv": "quart", "vii": "setè", "viii": "vuitè"},
}
#: Patterns of a syllable's onset with nucleus, and of its coda.
ONSETS = {
    "es": ["[bcfgklp]?[l]?[aeiouàáèéíïòóúü]+", "[bcfgkpdt]?[r]?[aeiouàáèéíïòóúü]+", "[bcdfghjklmnñopqrstuvwxz]?[aeiouàáèéíïòóúü]+"],
    "ca": ["[bcfgklp]?[l]?[aeiouàáèéíïòóúü]+", "[bcfgkpdt]?[r]?[aeiouàáèéíïòóúü]+", "ny[aeiouàáèéíïòóúü]+", "^psi", "^gno", "^pne", "[bcdfghjklmnopqrstuvwxz]?[aeiouàáèéíïòóúü]+"],
}
CODAS = {"es": ["[lrm]?[bcdfglmpt]?s?", "[bcçdfghjklmnopqrstuvwxz]?s?"], "ca": ["[lrm]?[bcdfglmpt]?s?", "ny?s?", "[bcçdfghjklmnopqrstuvwxz]?s?"]}
#: What may stand before and after a word.
OPENING, CLOSING = '(¡¿"«“‘', ',.;:»”’?!"'


def symbols(lang: str) -> dict[str, str]:
    """The name of every sign, currency and Greek letter."""
    small = {k.lower(): v for k, v in GREEK[lang].items()} | GREEK_SMALL[lang]
    return GREEK[lang] | small | SIGNS[lang] | CURRENCY[lang]


def _below_thousand(n: int, lang: str) -> str:
    if n < 30:
        return UNITS[lang][n]
    if n < 100:
        ten, rest = TENS[lang][n // 10 - 3], n % 10
        return ten if not rest else f"{ten} y {UNITS[lang][rest]}" if lang == "es" else f"{ten}-{UNITS[lang][rest]}"
    hundred, rest = n // 100, n % 100
    if lang == "es":
        head = "cien" if n == 100 else HUNDREDS_ES[hundred - 1]
    else:
        head = "cent" if hundred == 1 else f"{UNITS[lang][hundred]}-cents"
    return f"{head} {_below_thousand(rest, lang)}" if rest else head


def cardinal(n: int, lang: str) -> str:
    """A whole number in words; from 10**12 on digit by digit."""
    if n >= 10**12:
        return " ".join(UNITS[lang][int(d)] for d in str(n))
    if n < 1000:
        return _below_thousand(n, lang)
    if n < 10**6:
        head, rest = n // 1000, n % 1000
        before = "" if head == 1 else _short(_below_thousand(head, lang), lang) + " "
        out = before + "mil"
    else:
        head, rest = n // 10**6, n % 10**6
        one, many = ("un millón", "millones") if lang == "es" else ("un milió", "milions")
        out = one if head == 1 else f"{_short(cardinal(head, lang), lang)} {many}"
    return f"{out} {cardinal(rest, lang)}" if rest else out


def _short(text: str, lang: str) -> str:
    """uno before a noun is un."""
    return re.sub(r"uno$", "ún" if text.endswith("veintiuno") else "un", text) if lang == "es" else re.sub(r"(^|-)u$", r"\1un", text)


def _numeral(n: int) -> str:
    """The Roman numeral of a number below 100, in small letters."""
    ones = lambda k, i, v, x: {9: i + x, 4: i + v}.get(k, v * (k // 5) + i * (k % 5))
    return ones(n // 10, "x", "l", "c") + ones(n % 10, "i", "v", "x")


def roman_numerals(lang: str) -> dict[str, str]:
    """Words of the Roman numerals of two letters or more."""
    number = lambda n: re.sub(r"(^|-)u$", r"\1un", cardinal(n, lang)) if lang == "ca" else cardinal(n, lang)
    return {x: number(n) for n in range(11, 100) if len(x := _numeral(n)) > 1} | ROMAN_ORDINALS[lang]


_PEEL = re.compile(f"([{re.escape(OPENING)}]*)(.+?)([{re.escape(CLOSING)}]*)", re.S)
_NUMERALS = {lang: roman_numerals(lang) for lang in LETTERS}
_EXPANSIONS = {lang: ABBREVIATIONS[lang] | ACRONYMS | ORDINALS[lang] for lang in LETTERS}
#: Longer patterns first.
_SYLLABLE = {lang: re.compile("|".join(sorted(map("".join, product(ONSETS[lang], CODAS[lang])), key=lambda x: -len(x)))) for lang in LETTERS}


def syllables(word: str, lang: str) -> list[str]:
    return _SYLLABLE[lang].findall(word.lower())


def initials(word: str, lang: str) -> str:
    """A word in capitals: as it is if it reads as syllables from end to end, else by the names of its letters."""
    return word if "".join(syllables(word, lang)) == word.lower() else " ".join(LETTERS[lang].get(c, c) for c in word)


@lru_cache(1 << 16)
def _expanded(token: str, lang: str) -> str:
    left, core, right = _PEEL.fullmatch(token).groups()
    if "'" in core or "-" in core or core.isnumeric():
        return token
    low, capitals = core.lower(), core.isupper()
    if capitals and low in _NUMERALS[lang]:
        core = _NUMERALS[lang][low]
    elif low in _EXPANSIONS[lang]:
        core = _EXPANSIONS[lang][low]
    elif capitals:
        core = initials(core, lang)
    return left + core + right


def expand(text: str, lang: str) -> str:
    """Spells out Roman numerals, abbreviations, ordinals and initialisms, keeping punctuation around words.

    Digits and ASCII letters are set apart first; parts around apostrophes and hyphens are words of their own.
    """
    text = re.sub(r"(?<=\d)(?=[A-Za-z])|(?<=[A-Za-z])(?=\d)", " ", text)
    tokens = text.replace("'", "' ").replace("-", " - ").split()
    known = _EXPANSIONS[lang]  # other words in small letters stay: they need no look at their parts, nor a place in the cache
    return " ".join([t if t.islower() and t.isalpha() and t not in known else _expanded(t, lang) for t in tokens]).replace("' ", "'").replace(" - ", "-")
