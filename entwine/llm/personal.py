"""Personal information in free text: found and replaced by typed placeholders (problem 10).

A skip-chain conditional random field over the places of a text that can hold personal data: strings like
addresses of mail, numbers, capitalised words with a number, and runs of capitalised words. Each place has the labels
its form allows; unary potentials come from features of form and context, chain potentials tie neighbouring
places, and skip potentials tie places that repeat or resemble each other anywhere in the text. Loopy max-product
messages between all places make labels agree across the document. All weights are trained together, by
pseudo-likelihood, on a bounded sample of texts: on the places, right and wrong ones of every kind, whose label is
beyond doubt. What shows the label is hidden from the features of every other such place, so that context is learnt.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwine.llm.words import ACTIVITIES, GIVEN, plain
from entwine.plans.durable import durable, spread

#: Texts on which weights are trained: the ones with the least hash of their text.
TRAIN_TEXTS = 3_000
#: Share of all distinct texts from which a capitalised word is no surname, unless it mostly stands where surnames do.
COMMON = 0.004
#: Rounds of message passing, at most.
ROUNDS = 8

LABELS = ("O", "email", "phone", "id_number", "street_address", "person_name")
ALLOWED = {"E": ("O", "email"), "N": ("O", "phone", "id_number"), "S": ("O", "street_address"), "W": ("O", "person_name")}

AT = r"(?:@|\s?[(\[{]\s?(?:at|arroba)\s?[)\]}]\s?|\sAT\s)"
DOT = r"(?:\.|\s?[(\[{]\s?(?:dot|punto|point|punkt)\s?[)\]}]\s?|\sDOT\s)"
EMAIL = rf"[A-Za-z0-9À-ÿ_%+'-]+(?:\.[A-Za-z0-9À-ÿ_%+'-]+)*{AT}[A-Za-z0-9À-ÿ-]+(?:{DOT}[A-Za-z0-9À-ÿ-]+)*{DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9])"
HOUSE = r"(?:nº|n°|no\.?|nr\.?)?\s?\d{1,4}(?:\s?bis\b|\s?ter\b|\s?-\s?[A-Za-z]\b|[a-zA-Z]\b(?![\w'’.]))?"
NAME = r"[A-ZÀ-ÝŁŚŻŹĆŃ][\w'’-]+(?:\s(?:de|del|la|los|les|des|du|da|do|di|der|van|von)?\s?[A-ZÀ-ÝŁŚŻŹĆŃ][\w'’-]+){0,3}?"
#: Words for streets before and after their names.
BEFORE = r"calle|c/|avda\.?|avenida|av\.|plaza|pza\.?|paseo|p\.º|camino|carretera|ronda|travesía|travesia|rua|travessa|praça|largo|via|viale|piazza|corso|vicolo|ul\.|al\.|aleja|ulica|plac"
MIDDLE = r"rue|avenue|bd|boulevard|impasse|allée|place|quai|chemin|route|cours|via|viale|piazza"
AFTER = r"Street|Road|Lane|Avenue|Square|Terrace|Drive|Close|Way|Place|Court|Quay|Row|St\.|Rd\."
JOINED = r"[A-ZÀ-ÝŁ][\w-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer|damm|straat|laan|plein|gracht|kade|dijk|singel|dreef)"
STREET = rf"(?:(?:(?<!\w)(?i:{BEFORE}|{MIDDLE})\s?{NAME},?\s{HOUSE})|(?:\b\d{{1,4}}(?:\s?bis|\s?ter|\s?-\s?[A-Za-z]|[a-zA-Z])?,?\s(?i:{MIDDLE})\s(?:de\s|du\s|des\s|la\s|l')*{NAME})|(?:\b\d{{1,4}}(?:\s?bis|\s?-\s?[A-Za-z]|[a-zA-Z])?,?\s{NAME}\s(?:{AFTER})(?!\w))|(?:{JOINED},?\s{HOUSE}))"
NUMBER = r"(?<![\w@/+.-])(?:[XYZ][ -]?\d{7}[ -]?[A-Z](?!\w)|\d{2}\.?\d{3}\.?\d{3}[ -]?[A-Z](?!\w)|[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z](?!\w)|\d{7}[A-Z]{1,2}(?!\w)|(?:\(\+?\d{1,5}\)|\+?\d+)(?:(?:[ ./-]|\s?-\s?)?(?:\(\d{1,5}\)|\d+))*(?![\w@/]|[.,]\d))"
WORD = r"[A-ZÀ-ÝŁŚŻŹĆŃĄĘ](?:[\w'’]+(?:-[A-ZÀ-Ý][\w'’]+)*|\.(?:-?[A-ZÀ-Ý]\.)?)"
PARTICLE = r"(?:de la|de los|del|de|da|do|dos|di|du|von|van der|van|y|e)"
RUN = rf"{WORD}(?:(?:,? | {PARTICLE} ){WORD}){{0,7}}"
PLACE = re.compile(rf"(?P<E>{EMAIL})|(?P<S>{STREET})|(?P<N>{NUMBER})|(?P<W>{RUN})")

#: Words by which numbers, people and organisations are announced, folded.
NOT_PERSONAL = re.compile(r"\b(?:invoice|factura|facture|rechnung|fattura|faktura|factuur|fatura|fa|expediente|hoja|dossier|feuille|akte|blatt|file|sheet|siren|siret|organisation|organization|entidad|einrichtung|structure|entreprise|empresa|ente|vat|ust|iva|kvk|krs|iban|euros?)\b(?: n[o°º]\.?| nr\.?)?[\s\w:'’]{0,12}$")
OF_PERSON = re.compile(r"(?:identit|\bdni\b|\bnie\b|\bnir\b|documento?|\bpiece\b|ausweis|numero|nummer|number|equivalente?|\bid\b|passport|pasaporte|pesel|\bbsn\b|codice fiscale|securite|securit|seguridad|steuer|titulaire|holder)\W*(?:n[o°º]\.?|:)?\W*$")
CALL = re.compile(r"(?:tel|telef|telefon|telefono|telephone|phone|mobile|movil|fax|llame|llamar|appel|call|anrufen|ruf|unter|chiam|zadzwon|bel\b|ligu|au|al|to)\w*\W*(?:al|le|au|the|unter)?\W*$")
ORG = frozenset(plain("""asociación fundación cooperativa centro especial empleo taller association fondation coopérative chantier insertion régie quartier
    werkstatt verein förderverein genossenschaft sozialbetrieb stiftung associazione fondazione sociale stowarzyszenie fundacja spółdzielnia socjalna stichting
    vereniging coöperatie society community trust company associação fundação entidad promotora träger porteuse grupo group groupe sociedad société""").split()) - {"entidad", "promotora", "trager", "porteuse"}
FORMS = frozenset("sl slu sa sas sarl scop scic gmbh ggmbh eg ev srl spa onlus ets bv ua ltd clg lda crl plc coop".split()) | frozenset(ACTIVITIES.split())
TITLES = frozenset("don dona d dna sr sra srta mme mlle m mr mrs ms miss herr frau dr dra prof sig signora signor pan pani dhr mevr ing lic".split())
GIVEN_NAMES = (frozenset(GIVEN) | frozenset(f for forms in GIVEN.values() for f in forms.split() if len(f) > 2)) - {"sole"}


def name_in(run: str, common: frozenset[str], before: str) -> tuple[int, int, bool] | None:
    """Start and end, in a run of capitalised words, of a person's name without title; whether a given name or only an initial shows it.

    None if the run holds no name, or an organisation's name of which a person's is part.
    """
    tokens = [(m.start(), m.end(), m[0]) for m in re.finditer(WORD, run)]
    folded = [plain(t.rstrip(".")).replace("’", "'") for _, _, t in tokens]
    kinds = []
    for f, (_, _, t) in zip(folded, tokens):
        if re.fullmatch(r"(?:[A-ZÀ-Ý]\.-?)+", t):
            kinds.append("i")
        elif f in TITLES:
            kinds.append("t")
        elif f in GIVEN_NAMES or "-" in f and f.split("-")[0] in GIVEN_NAMES:
            kinds.append("g")
        elif f in ORG:
            kinds.append("o")
        elif f in FORMS or f in common or len(f) < 3:
            kinds.append("c")
        else:
            kinds.append("s")
    n = len(tokens)
    gaps = [run[tokens[i][1] : tokens[i + 1][0]] for i in range(n - 1)] + [""]
    for i in range(n):
        if kinds[i] not in "gi":
            continue
        if kinds[i] == "i" and folded[i] in ("d", "m"):
            ahead = next((x for x in range(i + 1, n) if kinds[x] != "s"), n)
            if i + 1 < n and kinds[i + 1] in "gi" or ahead < n and kinds[ahead] == "g" and "," in gaps[ahead - 1]:
                continue  # a title
        j = i
        while j + 1 < n and kinds[j + 1] in "gi" and not gaps[j].strip() and j - i < 2:
            j += 1
        k = j
        while k + 1 < n and kinds[k + 1] == "s" and "," not in gaps[k] and k - j < 2:
            link = gaps[k].strip()
            if link in ("y", "e") and not (k > j and gaps[k - 1].strip()):  # another person, unless the surname before has a particle
                break
            k += 1
        if k == j and j > i and kinds[j] == "g":  # a surname that is a given name, too
            k, j = j, j - 1
        start = i
        if k == j:  # no surname behind it: before it, with or without a comma
            start = i
            while start > 0 and kinds[start - 1] == "s" and i - start < 2 and (gaps[start - 1].strip(" \n") == "" or start == i and gaps[start - 1].strip() == ","):
                start -= 1
            if start == i:
                continue
        ahead = re.search(r"([^\W\d_]+) $", before)
        head = plain(ahead[1]) if not start and ahead and ahead[1][0].isupper() else ""
        if start and "\n" in gaps[start - 1]:
            pass  # another line: what stands before is no part of it
        elif head in ORG or any(x == "o" for x in kinds[max(0, start - 3) : start]):
            return None
        if k + 1 < n and "," not in gaps[k] and (kinds[k + 1] == "o" or folded[k + 1] in FORMS):
            return None
        return tokens[start][0], tokens[k][1], "g" in kinds[start : k + 1]
    return None


class Place:
    """A place of a text: its kind, features, the label that is beyond doubt, if any, and what it has in common with its repetitions."""

    __slots__ = ("kind", "start", "end", "value", "features", "hidden", "silver", "key")

    def __init__(self, kind: str, start: int, end: int, value: str):
        self.kind, self.start, self.end, self.value = kind, start, end, value
        self.features: list[str] = []
        self.hidden: list[str] = []
        self.silver: str | None = None
        self.key = plain(value) if kind != "N" else re.sub(r"\D", "", value)


def number_shape(value: str) -> str:
    return re.sub(r"9+", lambda m: f"9{len(m[0])}", re.sub(r"\d", "9", re.sub(r"[A-Z]", "A", value)))


def number_place(m: re.Match, before: str, after: str) -> Place | None:
    """A number that may be personal: label by what announces it and by its form, context as features."""
    value = m[0]
    digits = re.sub(r"\D", "", value)
    if len(digits) < 7 or re.fullmatch(r"\d{1,2}[./-]\d{1,2}[./-]\d{4}|(?:19|20)\d\d \d{1,3}", value) or len(digits) > 17:
        return None
    place = Place("N", m.start(), m.end(), value)
    no, person, call = bool(NOT_PERSONAL.search(before[-40:])), bool(OF_PERSON.search(before)), bool(CALL.search(before[-24:]))
    lettered = bool(re.search("[A-Z]", value))
    international = bool(re.match(r"\(?\+|00\d{2}", value))
    shown = bool(re.match(r"\W*(?:a ete presente|was presented|wurde von|fue presentado|lo presento|presentado)", after))
    if no and not person:
        place.silver = "O"
    elif lettered or (person or shown) and not international:
        place.silver = "id_number"
    elif international or call or re.match(r"\(?0", value) and len(digits) != 11 or len(digits) == 9 and digits[0] in "6789":
        place.silver = "phone"
    elif len(digits) in (11, 15):
        place.silver = "id_number"
    place.features = [f"no={no}", f"no={no},person={person or shown}", f"person={person or shown},plus={international}", f"call={call},no={no}", f"letter={lettered},no={no}", f"plus={international}", f"n={len(digits)}", f"n={len(digits)},no={no}", f"shape={number_shape(value)}", f"first={digits[0]}", f"n={len(digits)},first={digits[0]}"]
    return place


def word_places(m: re.Match, text: str, common: frozenset[str]) -> list[Place]:
    """The person's name in a run of capitalised words, else the two or three words of it that might be one; and, if a number follows, what might be an address."""
    run, out = m[0], []
    tokens = list(re.finditer(WORD, run))
    folded = [plain(t[0].rstrip(".")).replace("’", "'") for t in tokens]
    org = [f in ORG or f in FORMS for f in folded]
    found = name_in(run, common, text[max(0, m.start() - 40) : m.start()])
    if found:
        start, end, given = found
        place = Place("W", m.start() + start, m.start() + end, run[start:end])
        place.silver = "person_name" if given else None
        place.hidden = ["listed" if given else "initial"]
        out.append(place)
    else:
        other = [not o and f not in common and f not in TITLES and len(f) > 2 for o, f in zip(org, folded)]
        at = next((i for i in range(len(tokens) - 1) if other[i] and other[i + 1] and run[tokens[i].end() : tokens[i + 1].start()] == " "), None)
        if at is not None:
            last = at + 1
            while last - at < 2 and last + 1 < len(tokens) and other[last + 1] and run[tokens[last].end() : tokens[last + 1].start()] == " ":
                last += 1
            place = Place("W", m.start() + tokens[at].start(), m.start() + tokens[last].end(), run[tokens[at].start() : tokens[last].end()])
            ahead = re.search(r"([^\W\d_]+) (?:[^\W\d_]{1,3} )?$", text[max(0, place.start - 40) : place.start])
            near = ahead is not None and (plain(ahead[1]) in ORG or plain(ahead[1]) in FORMS)
            if near or any(org[max(0, at - 3) : last + 2]):
                place.silver = "O"
            place.hidden = ["unlisted"]
            out.append(place)
    if number := re.match(r",?\s\d{1,4}(?![\w.,/-]*\d)", text[m.end() : m.end() + 8]):
        first = tokens[max(0, len(tokens) - 2)].start()
        if not out or m.start() + first >= out[-1].end:
            place = Place("S", m.start() + first, m.end() + number.end(), run[first:] + number[0])
            place.silver = "O" if org[-1] or NOT_PERSONAL.search(plain(run) + " ") else None
            place.hidden, place.features = ["way=none"], []
            out.append(place)
    return out


def places(text: str, common: frozenset[str]) -> list[Place]:
    """The places of a text in order, with features and, where nothing is in doubt, a label for training."""
    out: list[Place] = []
    at = 0
    while m := PLACE.search(text, at):
        kind, at = m.lastgroup, m.end()
        if kind == "W":
            here = word_places(m, text, common)
            if here and here[0].kind == "W":
                at = here[0].end if here[0].hidden != ["unlisted"] else at
                here = here if here[0].hidden == ["unlisted"] or len(here) == 1 else here[:1]
        elif kind == "N":
            place = number_place(m, plain(text[max(0, m.start() - 60) : m.start()]), plain(text[m.end() : m.end() + 20]))
            here = [place] if place else []
        else:
            place = Place(kind, m.start(), m.end(), m[0].rstrip())
            place.silver, place.hidden = ("email", ["host"]) if kind == "E" else ("street_address", ["way=known"])
            place.features = ["plain" if "@" in m[0] else "spelled"] if kind == "E" else [f"joined={bool(re.match(JOINED, m[0]))}"]
            here = [place]
        for place in here:
            before, after = plain(text[max(0, place.start - 60) : place.start]), plain(text[place.end : place.end + 20])
            words = re.findall(r"[^\W\d_]+", before)[-3:]
            if place.kind == "W":
                place.features += [f"words={len(place.value.split())}", "caps" if place.value.isupper() else "mixed", f"title={bool(words) and words[-1] in TITLES}", f"org={bool(words) and (words[-1] in ORG or words[-1] in FORMS)}", f"start={not before.strip() or before.rstrip()[-1:] in '.!?:'}"]
            tail = re.match(r"\W*([^\W\d_]*)", after)[1]
            place.features = [f"{place.kind}.{f}" for f in [*place.features, *(f"w{i}={w}" for i, w in enumerate(reversed(words))), f"next={after[:1]}", f"prev={before[-1:]}", f"then={tail}", ""]]
            place.hidden = [f"{place.kind}.{f}" for f in place.hidden]
        out += here
    return out


def repetitions(nodes: list[Place]) -> list[tuple[int, int]]:
    """Pairs of places of one kind that repeat or resemble each other, each with the next one, so that a group costs no more than its size."""
    same: dict[tuple[str, str], int] = {}
    out: dict[tuple[int, int], None] = {}
    for i, p in enumerate(nodes):
        for part in {p.key, *(w for w in p.key.split() if p.kind == "W" and len(w) > 3)}:
            if (j := same.get((p.kind, part))) is not None:
                out[j, i] = None
            same[p.kind, part] = i
    return list(out)


class Field:
    """Weights of the field: unary (a row of labels by feature), chain (left label, right label), skip (by kind, for agreement)."""

    def __init__(self, unary: dict[str, np.ndarray], chain: np.ndarray, skip: dict[str, float]):
        self.unary, self.chain, self.skip = unary, chain, skip

    def scores(self, place: Place) -> np.ndarray:
        out = CLOSED[place.kind].copy()
        for f in (*place.features, *place.hidden):
            if (row := self.unary.get(f)) is not None:
                out += row
        return out

    def label(self, nodes: list[Place], rounds: int = ROUNDS) -> list[str]:
        """Max-product messages along the chain and the skips between all places, in rounds until nothing changes."""
        if not nodes:
            return []
        scores = np.stack([self.scores(p) for p in nodes])
        if len(nodes) > 1 and rounds:
            n, skips = len(nodes), repetitions(nodes)
            chain = np.arange(n - 1)
            left = np.concatenate([chain, np.array([i for i, _ in skips], np.int64)])
            right = np.concatenate([chain + 1, np.array([j for _, j in skips], np.int64)])
            eye = np.eye(len(LABELS))
            tie = np.concatenate([np.broadcast_to(self.chain, (n - 1, len(LABELS), len(LABELS))), np.stack([self.skip[nodes[i].kind] * eye for i, _ in skips])]) if skips else np.broadcast_to(self.chain, (n - 1, len(LABELS), len(LABELS)))
            e = len(left)
            source, target = np.concatenate([left, right]), np.concatenate([right, left])
            tie = np.concatenate([tie, tie.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
            sent = np.zeros((2 * e, len(LABELS)))
            beliefs = scores
            for _ in range(rounds):
                fresh = (np.maximum(beliefs[source] - sent[back], -1e9)[:, :, None] + tie).max(1)
                fresh -= fresh.max(1, keepdims=True)
                still = np.abs(fresh - sent).max() < 1e-6
                sent = fresh
                beliefs = scores.copy()
                np.add.at(beliefs, target, sent)
                if still:
                    break
            scores = beliefs
        return [LABELS[i] for i in (scores + np.stack([CLOSED[p.kind] for p in nodes])).argmax(1)]


#: Weight for O that features start from: words that nothing shows to be a name or street are none unless their context says so.
PRIOR = {"W.unlisted": 4.0, "S.way=none": 2.0}
#: 0 for the labels that a kind allows, far below for others.
CLOSED = {kind: np.array([0.0 if y in allowed else -1e6 for y in LABELS]) for kind, allowed in ALLOWED.items()}


def train(texts: list[str], common: frozenset[str], steps: int = 80, rate: float = 0.5, decay: float = 2e-3) -> Field:
    """All weights together by pseudo-likelihood: each labelled place given its features and the labels of its neighbours and repetitions."""
    docs = [d for t in texts if (d := places(t, common))]
    nodes = [p for d in docs for p in d]
    known = [p for p in nodes if p.silver]
    number = {id(p): i for i, p in enumerate(known)}
    size = len(LABELS)
    skip_kinds = list(ALLOWED)
    none = np.array([float(y == "O") for y in LABELS])
    if not known:
        return Field({f: w * none for f, w in PRIOR.items()}, np.zeros((size, size)), dict.fromkeys(skip_kinds, 1.0))
    # what shows the label is hidden for every other value
    said = [p.features if crc32(p.key.encode("utf-8", "replace")) % 2 else [*p.features, *p.hidden] for p in known]
    index = {f: i for i, f in enumerate(dict.fromkeys([f for fs in said for f in fs] + list(PRIOR)))}
    cols = np.array([index[f] for fs in said for f in fs])
    starts = np.concatenate([[0], np.cumsum([len(fs) for fs in said])[:-1]])
    rows = np.repeat(np.arange(len(known)), [len(fs) for fs in said])
    by_col = np.argsort(cols, kind="stable")
    used, col_starts = np.unique(cols[by_col], return_index=True)
    closed = np.stack([CLOSED[p.kind] for p in known])
    gold = np.array([LABELS.index(p.silver) for p in known])
    want = np.eye(size)[gold]
    left, right = np.full(len(known), size), np.full(len(known), size)  # the label beside; size where nothing is known
    repeated = np.zeros((len(known), size))
    for d in docs:
        for p, q in zip(d, d[1:]):
            if p.silver and q.silver:
                left[number[id(q)]], right[number[id(p)]] = LABELS.index(p.silver), LABELS.index(q.silver)
        for i, j in repetitions(d):
            if d[i].silver and d[j].silver:
                repeated[number[id(d[i])], LABELS.index(d[j].silver)] += 1
                repeated[number[id(d[j])], LABELS.index(d[i].silver)] += 1
    kind = np.array([skip_kinds.index(p.kind) for p in known])
    prior = np.zeros((len(index), size))
    for f, w in PRIOR.items():
        prior[index[f]] = w * none
    unary, chain, skip = prior.copy(), np.zeros((size + 1, size + 1)), np.zeros(len(skip_kinds))
    weight = np.sqrt(np.bincount(cols, minlength=len(index)) + 1.0)[:, None]
    for _ in range(steps):
        logits = closed + np.add.reduceat(unary[cols], starts) + chain[left][:, :size] + chain[:size, right].T + skip[kind][:, None] * repeated
        prob = np.exp(logits - logits.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        miss = want - prob
        step = -decay * (unary - prior) * weight
        step[used] += np.add.reduceat(miss[rows[by_col]], col_starts) / weight[used]
        unary += rate * step
        grad = np.zeros_like(chain)
        np.add.at(grad[:, :size], left, miss)
        np.add.at(grad.T[:, :size], right, miss)
        grad[size, :], grad[:, size] = 0.0, 0.0
        chain += rate * (grad / np.sqrt(len(known)) - decay * chain * 10)
        skip += rate * (np.bincount(kind, (miss * repeated).sum(1), len(skip_kinds)) / np.sqrt(len(known)) - decay * skip * 10)
    return Field({f: unary[i] for f, i in index.items()}, chain[:size, :size], dict(zip(skip_kinds, np.maximum(skip, 0.0).tolist())))


def beside_names(text: str) -> set[str]:
    """Folded words that stand as surnames do: up to two behind a given name, an initial or a title, or before a given name and a comma."""
    out: set[str] = set()
    for m in re.finditer(RUN, text):
        tokens = list(re.finditer(WORD, m[0]))
        if len(tokens) < 2:
            continue
        folded = [plain(t[0].rstrip(".")).replace("’", "'") for t in tokens]
        shows = [f in GIVEN_NAMES or f in TITLES or bool(re.fullmatch(r"(?:[A-ZÀ-Ý]\.-?)+", t[0])) for f, t in zip(folded, tokens)]
        behind = 0
        for i, f in enumerate(folded):
            comma = i > 0 and "," in m[0][tokens[i - 1].end() : tokens[i].start()]
            if shows[i]:
                behind = 2
                if comma and not shows[i - 1]:
                    out.add(folded[i - 1])
            elif behind and not comma:
                out.add(f)
                behind -= 1
            else:
                behind = 0
    return out


def common_words(texts: DataFrame) -> frozenset[str]:
    """The words of `texts` (text, distinct) that are no surname, however they are written.

    They are in more than COMMON of all texts, and in most of these either in lower case only or not where
    surnames stand. Only they come to the driver: with some hundred words a text at most some ten thousand.
    """

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often, lower, named = Counter(), Counter(), Counter()
        texts = 0
        for batch in batches:
            for text in batch.text:
                texts += 1
                small: set[str] = set()
                large: set[str] = set()
                for w in set(re.findall(r"[^\W\d_]+", unicodedata.normalize("NFC", text))):
                    (small if w.islower() else large).add(w)
                small, large = (set(re.findall(r"[^\W\d_]+", plain(" ".join(x)))) for x in (small, large))
                often.update(small | large)
                lower.update(small - large)
                named.update(beside_names(text) & large)
        rows = [(w, n, lower[w], named[w]) for w, n in often.items()] + [("", texts, 0, 0)]  # the empty word counts the texts
        yield pd.DataFrame(rows, columns=["word", "n", "low", "named"])

    counts = durable(spread(texts).mapInPandas(tally, "word string, n long, low long, named long").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "low", "named")]))
    total = counts.where("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    usual = counts.where(F.col("word") != "").where(F.col("n") > max(3, COMMON * total)).where("2 * low > n OR 2 * named < n")
    return frozenset(r.word for r in usual.select("word").collect()) - GIVEN_NAMES


def fitted(documents: DataFrame) -> tuple[Field, frozenset[str]]:
    """Field, from about TRAIN_TEXTS texts, and common words, from all; the sample and those words are all that comes to the driver.

    The sample is cut by a threshold on the texts' hashes, so nothing but the sample is sorted or moved.
    """
    texts = documents.where("text IS NOT NULL").select("text")
    share = min(1.0, 2.0 * TRAIN_TEXTS / max(1, texts.count()))
    drawn = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) <= int(share * (1 << 30))).distinct()
    sample = [r.text for r in drawn.orderBy(F.xxhash64("text")).limit(TRAIN_TEXTS).collect()]
    common = common_words(texts.distinct())
    return train(sample, common), common


def find(text: str | None, field: Field, common: frozenset[str]) -> list[tuple[int, int, str]]:
    """(start, end, type) of the personal data in a text, in order."""
    nodes = places(text, common) if text else []
    out, at = [], 0
    for p, y in zip(nodes, field.label(nodes)):
        if y != "O" and p.start >= at:  # of places that overlap the first
            out.append((p.start, p.end, y))
            at = p.end
    return out


def mask(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with [TYPE] in place of each find; equal values of a type get equal numbers, so the text stays readable."""
    out, at, numbers = [], 0, {}
    for start, end, kind in found:
        n = numbers.setdefault((kind, plain(text[start:end])), sum(k == kind for k, _ in numbers) + 1)
        out += [text[at:start], f"[{kind.upper()}_{n}]"]
        at = end
    return "".join([*out, text[at:]])


def scan(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(places, texts): (doc_id, pii_type, pii_value) distinct, and (doc_id, masked) for every row.

    Null texts hold nothing and stay null; texts of any length are scanned whole.
    """
    shared = documents.sparkSession.sparkContext.broadcast(fitted(documents))
    rows = spread(documents.select("doc_id", "text"))

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field, common = shared.value
        for batch in batches:
            out = [(d, y, t[a:b]) for d, t in zip(batch.doc_id, batch.text) for a, b, y in find(t, field, common)]
            yield pd.DataFrame(out, columns=["doc_id", "pii_type", "pii_value"])

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field, common = shared.value
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id, "masked": [None if t is None else mask(t, find(t, field, common)) for t in batch.text]})

    found = rows.where("text IS NOT NULL").mapInPandas(values, "doc_id long, pii_type string, pii_value string").distinct()
    return found, rows.mapInPandas(texts, "doc_id long, masked string")
