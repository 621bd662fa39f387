"""Word lists of organisation names in the languages of the registers.

Keys of WORDS are the countries in whose names a word is usual; each text is a space-separated list
of folded words (lower case, without accents). Words that stand in several lists belong to all of them.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

WORDS = {
    "ES": """asociacion fundacion cooperativa coop sociedad limitada laboral unipersonal anonima centro especial
        de del la los las y empleo empresa insercion autonomo autonoma catering limpiezas reciclaje lavanderia
        formacion jardineria servicios integrales construccion carpinteria textil transporte sl slu sa sal sll scoop
        cee ei grupo tienda mensajeria asoc fdcion fund s l u es esp""",
    "FR": """association fondation cooperative societe responsabilite limitee a d de du des la le les et l interet collectif
        participative chantier insertion regie quartier entreprise adaptee nettoyage recyclage restauration espaces
        verts eco habitat services jardins sarl sas sa scop scic sasu eurl ei gie asso ci rq ess groupe boutique
        individuelle entrepreneur coop fr fra""",
    "DE": """genossenschaft verein forderverein foerderverein sozialbetrieb werkstatt werkstaetten fur fuer der die das und
        behinderte menschen dienstleistungen druckerei gartenbau mobelhaus moebelhaus kuche kueche wascherei waescherei
        gmbh ggmbh ug ag kg eg ev ek e v gemeinnutzige gemeinnuetzige eingetragene eingetragener gesellschaft mit
        beschrankter beschraenkter haftung eingetragenes kaufmann wfbm fv dnst gruppe laden integrationsbetrieb de deu
        inhaber inh stiftung reinigung""",
    "IT": """associazione fondazione cooperativa sociale coop soc societa responsabilita limitata di per azioni a
        organizzazione non lucrativa utilita ente del terzo settore onlus ets aps odv agricola formazione pulizie
        ristorazione servizi srl srls spa sas snc ditta individuale impresa gruppo negozio ass ne fond scs it ita firma""",
    "PL": """stowarzyszenie fundacja spoldzielnia socjalna spolka z ograniczona odpowiedzialnoscia o non profit oo sp zoo
        gastronomia ogrody pralnia uslugi sklep grupa spz pl pol firma""",
    "NL": """stichting vereniging cooperatie uitgesloten aansprakelijkheid besloten vennootschap met beperkte
        groenbeheer werkplaats keuken diensten bv ua nv vof eenmanszaak stg groep winkel nl nld""",
    "IE": """association society community trust company limited by guarantee clg ltd plc dac cic of the and for
        services repairs kitchens gardens group shop cleaning training catering assn comm gdns servs co soc trading
        as ta ie irl sole trader""",
    "PT": """associacao fundacao cooperativa responsabilidade limitada lda sa crl cooperativo servicos limpezas jardins
        refeicoes lavandaria formacao unipessoal sociedade eni empresario em nome individual grupo loja cooperativas coop pt prt""",
}

#: Abbreviations that are no prefix of the word they stand for.
SHORT_FORMS = {
    "fdcion": "fundacion", "asoc": "asociacion", "asso": "association", "assn": "association", "rq": "regie de quartier",
    "ci": "chantier insertion", "cee": "centro especial empleo", "wfbm": "werkstatt", "fv": "forderverein", "soz": "sozialbetrieb",
    "betrieb": "sozialbetrieb", "sozbetrieb": "sozialbetrieb", "stg": "stichting", "dnst": "dienstleistungen", "gdns": "gardens", "servs": "services",
    "assne": "associazione", "fondne": "fondazione", "ne": "", "st": "", "tr": "trust", "soc": "", "foerderverein": "forderverein", "moebelhaus": "mobelhaus", "waescherei": "wascherei",
    "kueche": "kuche", "foerdverein": "forderverein", "fordverein": "forderverein", "spoldz": "spoldzielnia", "waesch": "wascherei", "moebelh": "mobelhaus", "kue": "kuche",
}

#: Words that say what an organisation does; two organisations may differ in nothing else.
ACTIVITIES = """catering limpiezas reciclaje lavanderia formacion jardineria servicios integrales nettoyage recyclage
    restauration espaces verts eco habitat services jardins dienstleistungen druckerei gartenbau mobelhaus kuche wascherei
    agricola formazione pulizie ristorazione servizi gastronomia ogrody pralnia uslugi groenbeheer werkplaats keuken diensten
    repairs kitchens gardens servicos limpezas refeicoes"""

#: Given names and the familiar forms in use for them.
GIVEN = {
    "maria": "ma mari marichu maruja mery", "jose": "pepe josep chema ze zeca", "francisco": "paco fran curro kiko pancho chico", "francisca": "paca paqui fran chica",
    "dolores": "lola loli", "concepcion": "concha conchi conchita", "ignacio": "nacho inaki", "manuel": "manolo manu", "jesus": "chus",
    "antonio": "toni tono toninho to", "rosario": "charo", "mercedes": "merche", "enrique": "quique", "guadalupe": "lupe", "isabel": "isa chabela",
    "elisabeth": "babette lisbeth lise elise sissi elsa lisa betty liz beth babeth lili", "frederic": "fred", "jerome": "je jej", "dominique": "domi dom", "francois": "fanfan",
    "catherine": "cathy kate", "philippe": "phil", "giuseppe": "beppe pino peppe", "luigi": "gigi gino luis", "domenico": "mimmo mimi nico", "francesco": "checco franco",
    "giovanni": "gianni nanni", "friedrich": "fritz fred frieder", "katharina": "kathe kaethe kathi katja kat katrin", "jurgen": "juergen jurgi jorg", "johannes": "hannes hans johann jan",
    "cornelia": "conny nelly corrie nel cor", "hendrik": "henk rik", "wilhelm": "willi", "heinrich": "heinz", "margaret": "peg peggy maggie meg madge", "william": "bill billy liam will willy",
    "seamus": "shay jim james", "malgorzata": "gosia malgosia", "katarzyna": "kasia", "stanislaw": "staszek stach", "conceicao": "sao",
    "joao": "joca", "aleksandra": "ola", "elzbieta": "ela", "krzysztof": "krzys", "robert": "bob rob", "elizabeth": "liz beth lizzy", "ric": "frederic",
    "soledad": "",
}

#: Country names, codes and common forms, folded.
COUNTRIES = {
    "ES": "es esp espana spain espagne spanien spagna hiszpania spanje espanha", "FR": "fr fra france francia frankreich francja frankrijk franca",
    "DE": "de deu ger deutschland germany alemania allemagne germania niemcy duitsland alemanha", "IT": "it ita italia italy italie italien wlochy italie",
    "PL": "pl pol polska poland polonia pologne polen polonia", "NL": "nl nld nederland netherlands holanda paysbas niederlande paesibassi holandia holland",
    "IE": "ie irl ireland irlanda irlande irland irlandia ierland eire", "PT": "pt prt portugal portogallo portugalia",
    "AT": "at aut osterreich austria autriche oesterreich", "BE": "be bel belgie belgium belgique belgica belgien", "DK": "dk dnk danmark denmark",
    "SE": "se swe sverige sweden", "FI": "fi fin suomi finland", "CZ": "cz cze cesko czechia", "GR": "gr grc greece ellada", "CH": "ch che schweiz suisse svizzera switzerland",
}

PLAIN = str.maketrans({"ł": "l", "Ł": "l", "ß": "ss", "ø": "o", "Ø": "o", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "ª": "a", "º": "o"})


#: Letters whose small ones PLAIN names though it does not name them, and the one that is small in two ways.
ALONE = re.compile("[ΣĐÐÞẞ]")
FOREIGN = re.compile(r"[^\x00-\x7f]")


def bare(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@lru_cache(1 << 12)
def bare_letter(c: str) -> str:
    return bare(c.translate(PLAIN))


def plain(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    if ALONE.search(text):
        return bare(text.translate(PLAIN).lower())
    return FOREIGN.sub(lambda m: bare_letter(m[0]), text.lower())
