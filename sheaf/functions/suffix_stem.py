"""Suffix stemmers for ten languages as rule tables.

A program is a list of steps, kept as data:

* ``("map", old, new)`` replaces characters one for one;
* ``("sub", pattern, new)`` replaces a pattern everywhere (``\\1`` is a group);
* ``("cut", region, rules)`` looks for the longest suffix of its rules that ends the
  word; with a region the suffix must lie inside it. The first rule that names this
  suffix and whose tests hold on the letters before it (the head) replaces it, after
  cutting ``cut`` more letters off the head. No rule: the word stays.

Regions are prefixes that a pattern marks: ``R1`` ends after the first non-vowel
behind a vowel, ``R2`` is the same again, ``RV`` depends on the language. ``MARK`` at
the end of a word says that an earlier step has changed it and keeps the later ones
off; the last step takes it away.

Danish, Dutch, Italian, Norwegian, Portuguese, Russian and Swedish follow the published
Snowball descriptions of these languages. Finnish, Hungarian and Turkish are pinned
shorter: the endings of number, case, possession and particles, without the rules that
restore a vowel of the stem; Turkish also without vowel harmony. Tokens must be lower
case; null tokens stay null, an empty token stays empty, tokens without a rule stay.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\u0003"
#: What may stand behind the end of a pattern.
LINE_ENDS = "\n\r\u0085\u2028\u2029"


def rule(suffixes: str, new: str = "", *tests: str, cut: int = 0) -> tuple:
    """Suffixes (blank between), what replaces them, tests of the head, letters of the head that go too."""
    return tuple(suffixes.split()), new, tests, cut


def _regions(vowels: str, rv: str = "", three: bool = False) -> dict[str, str]:
    """Patterns of the prefixes before R1 (of three letters at least, if ``three``), R2 and RV."""
    v, c = f"[{vowels}]", f"[^{vowels}]"
    r1 = f"{c}*{v}+{c}"
    first = f"(?:{c}+{v}+{c}|{v}{v}+{c}|{v}{c}.)" if three else f"(?:{r1})"
    return {"R1": first, "R2": f"(?:{r1}{r1})", "RV": rv, "V": v, "C": c}


def _romance_rv(vowels: str) -> str:
    v, c = f"[{vowels}]", f"[^{vowels}]"
    return f"(?:.{c}{c}*{v}|{v}{v}+{c}|{c}{v}.)"


# Vowels of each language, and its endings as Snowball publishes them (Finnish, Hungarian,
# Turkish: a shorter list).
_SCAND_DA, _SCAND_NO, _SCAND_SV = "aeiouyæåø", "aeiouyæåø", "aeiouyäåö"
_NL, _IT, _PT, _RU = "aeiouyè", "aeiouàèìòù", "aeiouáéíóúâêô", "аеиоуыэюя"
_FI, _HU, _TR = "aeiouyäö", "aáeéiíoóöőuúüű", "aeıioöuü"
# Letters before the Dutch ending -en: a consonant, but not gem.
_NL_EN = "(?:[^aeiouyèm]|[^e]m|[^g]em)$"
_IT_PRONOUNS = ("ci gli la le li lo mi ne si ti vi sene gliela gliele glieli glielo gliene mela mele meli melo mene tela tele "
                "teli telo tene cela cele celi celo cene vela vele veli velo vene")
_RU_ADJECTIVE = "ее ие ые ое ими ыми ей ий ый ой ем им ым ом его ого ему ому их ых ую юю ая яя ою ею"

REGIONS = {
    "danish": _regions(_SCAND_DA, three=True), "norwegian": _regions(_SCAND_NO, three=True),
    "swedish": _regions(_SCAND_SV, three=True), "dutch": _regions(_NL, three=True),
    "italian": _regions(_IT, _romance_rv(_IT)), "portuguese": _regions(_PT, _romance_rv(_PT)),
    "russian": _regions(_RU, f"(?:[^{_RU}]*[{_RU}])"), "finnish": _regions(_FI),
    "hungarian": _regions(_HU, f"(?:[{_HU}]+[^{_HU}]|[^{_HU}]+[{_HU}])"), "turkish": _regions(_TR, f"(?:[^{_TR}]*[{_TR}][^{_TR}])"),
}

_UNMARK = ("sub", MARK, "")

PROGRAMS: dict[str, list[tuple]] = {
    "danish": [
        ("cut", "R1", [
            rule("hed ethed ered e erede ende erende ene erne ere en heden eren er heder erer heds es endes erendes "
                 "enes ernes eres ens hedens erens ers ets erets et eret"),
            rule("s", "", "[abcdfghjklmnoprtvyzå]$")]),
        ("cut", "R1", [rule("gd gt", "g"), rule("dt", "d"), rule("kt", "k")]),
        ("cut", None, [rule("igst", "ig")]),
        ("cut", "R1", [rule("ig lig elig els", "", "^{R1}.*(?:gd|dt|gt|kt)$", cut=1), rule("ig lig elig els"),
                       rule("løst", "løs")]),
        ("cut", "R1", [rule(f"{c}{c}", c) for c in "bcdfghjklmnpqrstvwxz"])],
    "norwegian": [
        ("cut", "R1", [
            rule("a e ede ande ende ane ene hetene en heten ar er heter as es edes endes enes hetenes ens hetens ers "
                 "ets et het ast"),
            rule("s", "", "[bcdfghjlmnoprtvyz]$"), rule("s", "", "{C}k$"), rule("erte ert", "er")]),
        ("cut", "R1", [rule("dt", "d"), rule("vt", "v")]),
        ("cut", "R1", [rule("leg eleg ig eig lig elig els lov elov slov hetslov")])],
    "swedish": [
        ("cut", "R1", [
            rule("a arna erna heterna orna ad e ade ande arne are aste en anden aren heten ern ar er heter or as arnas "
                 "ernas ornas es ades andes ens arens hetens erns at andet het ast"),
            rule("s", "", "[bcdfghjklmnoprtvy]$")]),
        ("cut", "R1", [rule("dd dt", "d"), rule("gd gt", "g"), rule("nn", "n"), rule("kt", "k"), rule("tt", "t")]),
        ("cut", "R1", [rule("lig ig els"), rule("löst", "lös"), rule("fullt", "full")])],
    "dutch": [
        ("map", "äëïöüáéíóú", "aeiouaeiou"),
        ("sub", "^y", "Y"), ("sub", "([aeiouyè])y", r"\1Y"), ("sub", "([aeiouyè])i([aeiouyè])", r"\1I\2"),
        ("cut", None, [
            rule("heden", "heid", "^{R1}"),
            rule("en ene", "", "^{R1}", "(?:kk|dd|tt)$", cut=1),
            rule("en ene", "", "^{R1}", _NL_EN),
            rule("s se", "", "^{R1}", "[^aeiouyèj]$")]),
        ("cut", None, [
            rule("bare", "", "^{R2}"), rule("bare", "bar", "^{R1}"),
            rule("e", "", "^{R1}", "(?:kk|dd|tt)$", cut=1), rule("e", "", "^{R1}", "{C}$")]),
        ("cut", None, [
            rule("heid", "", "^{R2}", "^{R1}.*en$", _NL_EN.replace("$", "en$"), cut=2), rule("heid", "", "^{R2}", "[^c]$")]),
        ("cut", None, [
            rule("end ing", "", "^{R2}", "^{R2}.*[^e]ig$", cut=2),
            rule("end ing", "", "^{R2}", "(?:kk|dd|tt)$", cut=1), rule("end ing", "", "^{R2}"),
            rule("ig", "", "^{R2}", "[^e]$"), rule("lijk", "", "^{R2}", "^{R1}.*{C}e$", cut=1),
            rule("lijk", "", "^{R2}"), rule("baar", "", "^{R2}")]),
        ("cut", None, [rule(f"{v}{v}{c}", f"{v}{c}", "[^aeiouyè]$") for v in "aeou" for c in "bcdfghjklmnpqrstvwxzY"]),
        ("map", "IY", "iy")],
    "italian": [
        ("map", "áéíóú", "àèìòù"), ("sub", "qu", "qU"),
        ("sub", f"([{_IT}])u([{_IT}])", r"\1U\2"), ("sub", f"([{_IT}])i([{_IT}])", r"\1I\2"),
        ("cut", None, [rule(_IT_PRONOUNS, "", "^{RV}.*(?:ando|endo)$"), rule(_IT_PRONOUNS, "e", "^{RV}.*(?:ar|er|ir)$")]),
        ("cut", None, [
            rule("anza anze ico ici ica ice iche ichi ismo ismi abile abili ibile ibili ista iste isti istà istè istì oso "
                 "osi osa ose mente atrice atrici ante anti", MARK, "^{R2}"),
            rule("azione azioni atore atori", MARK, "^{R2}.*ic$", cut=2), rule("azione azioni atore atori", MARK, "^{R2}"),
            rule("logia logie", "log" + MARK, "^{R2}"), rule("uzione uzioni usione usioni", "u" + MARK, "^{R2}"),
            rule("enza enze", "ente" + MARK, "^{R2}"), rule("amento amenti imento imenti", MARK, "^{RV}"),
            rule("amente", MARK, "^{R1}", "^{R2}.*ativ$", cut=4), rule("amente", MARK, "^{R1}", "^{R2}.*(?:iv|os|ic)$", cut=2),
            rule("amente", MARK, "^{R1}", "^{R2}.*abil$", cut=4), rule("amente", MARK, "^{R1}"),
            rule("ità", MARK, "^{R2}.*abil$", cut=4), rule("ità", MARK, "^{R2}.*(?:ic|iv)$", cut=2), rule("ità", MARK, "^{R2}"),
            rule("ivo ivi iva ive", MARK, "^{R2}.*icat$", cut=4), rule("ivo ivi iva ive", MARK, "^{R2}.*at$", cut=2),
            rule("ivo ivi iva ive", MARK, "^{R2}")]),
        ("cut", "RV", [rule(
            "ammo ando ano are arono asse assero assi assimo ata ate ati ato ava avamo avano avate avi avo emmo enda ende "
            "endi endo erà erai eranno ere erebbe erebbero erei eremmo eremo ereste eresti erete erò erono essero ete eva "
            "evamo evano evate evi evo Iamo iamo immo irà irai iranno ire irebbe irebbero irei iremmo iremo ireste iresti "
            "irete irò irono isca iscano isce isci isco iscono issero ita ite iti ito iva ivamo ivano ivate ivi ivo ono uta "
            "ute uti uto ar ir")]),
        _UNMARK,
        ("cut", "RV", [rule("a e i o à è ì ò", "", "^{RV}.*i$", cut=1), rule("a e i o à è ì ò")]),
        ("cut", "RV", [rule("ch", "c"), rule("gh", "g")]),
        ("map", "IU", "iu")],
    "portuguese": [
        ("sub", "ã", "a~"), ("sub", "õ", "o~"),
        ("cut", None, [
            rule("eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento "
                 "imentos adora ador aça~o adoras adores aço~es ante antes ância", MARK, "^{R2}"),
            rule("logia logias", "log" + MARK, "^{R2}"), rule("uça~o uço~es", "u" + MARK, "^{R2}"),
            rule("ência ências", "ente" + MARK, "^{R2}"),
            rule("amente", MARK, "^{R1}", "^{R2}.*ativ$", cut=4), rule("amente", MARK, "^{R1}", "^{R2}.*(?:iv|os|ic|ad)$", cut=2),
            rule("amente", MARK, "^{R1}"),
            rule("mente", MARK, "^{R2}.*(?:ante|avel|ável|ível)$", cut=4), rule("mente", MARK, "^{R2}"),
            rule("idade idades", MARK, "^{R2}.*abil$", cut=4), rule("idade idades", MARK, "^{R2}.*(?:ic|iv)$", cut=2),
            rule("idade idades", MARK, "^{R2}"),
            rule("iva ivo ivas ivos", MARK, "^{R2}.*at$", cut=2), rule("iva ivo ivas ivos", MARK, "^{R2}"),
            rule("ira iras", "ir" + MARK, "^{RV}", "e$")]),
        ("cut", "RV", [rule(
            "ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am iam ariam "
            "eriam iriam aram eram iram avam em arem erem irem assem essem issem ado ido ando endo indo ara~o era~o ira~o ar "
            "er ir as adas idas ias arias erias irias arás aras erás eras irás avas es ardes erdes irdes ares eres ires asses "
            "esses isses astes estes istes is ais eis íeis aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis "
            "ésseis ísseis áveis ados idos ámos amos íamos aríamos eríamos iríamos áramos éramos íramos ávamos emos aremos "
            "eremos iremos ássemos êssemos íssemos imos armos ermos irmos eu iu ou ira iras", MARK)]),
        ("cut", None, [rule("i" + MARK, MARK, "^{RV}", "c$")]),
        ("cut", "RV", [rule("os a i o á í ó")]),
        _UNMARK,
        ("cut", None, [rule("e é ê", "", "^{RV}.*u$", "gu$", cut=1), rule("e é ê", "", "^{RV}.*i$", "ci$", cut=1),
                       rule("e é ê", "", "^{RV}"), rule("ç", "c")]),
        ("sub", "a~", "ã"), ("sub", "o~", "õ")],
    "russian": [
        ("map", "ё", "е"),
        ("cut", "RV", [rule("в вши вшись", MARK, "^{RV}.*[ая]$"), rule("ив ивши ившись ыв ывши ывшись", MARK)]),
        ("cut", "RV", [rule("ся сь")]),
        ("cut", "RV", [
            rule(_RU_ADJECTIVE, MARK, "^{RV}.*(?:ивш|ывш|ующ)$", cut=3),
            rule(_RU_ADJECTIVE, MARK, "^{RV}.*[ая](?:ем|нн|вш|ющ)$", cut=2),
            rule(_RU_ADJECTIVE, MARK, "^{RV}.*[ая]щ$", cut=1), rule(_RU_ADJECTIVE, MARK)]),
        ("cut", "RV", [
            rule("ла на ете йте ли й л ем н ло но ет ют ны ть ешь нно", MARK, "^{RV}.*[ая]$"),
            rule("ила ыла ена ейте уйте ите или ыли ей уй ил ыл им ым ен ило ыло ено ят ует уют ит ыт ены ить ыть ишь ую "
                 "ю", MARK)]),
        ("cut", "RV", [rule(
            "а ев ов ие ье е иями ями ами еи ии и ией ей ой ий й иям ям ием ем ам ом о у ах иях ях ы ь ию ью ю ия ья я")]),
        _UNMARK,
        ("cut", "RV", [rule("и")]),
        ("cut", "RV", [rule("ост ость", "", "^{R2}")]),
        ("cut", "RV", [rule("ейш ейше", "", "^{RV}.*нн$", cut=1), rule("ейш ейше"), rule("нн", "н"), rule("ь")])],
    "finnish": [
        ("cut", "R1", [rule("kin kaan kään ko kö han hän pa pä", "", "[aeiouyäönt]$"), rule("sti", "", "^{R2}")]),
        ("cut", "R1", [rule("si", "", "[^k]$"), rule("ni nsa nsä mme nne")]),
        ("cut", "R1", [
            *[rule(f"h{v}n", "", f"{v}$") for v in "aeioäö"], rule("siin tten", "", "[aeiouyäö]i$"), rule("seen", "", "(?:aa|ee|ii|oo|uu|ää|öö)$"),
            rule("tta ttä", "", "e$"), rule("ta tä ssa ssä sta stä lla llä lta ltä lle na nä ksi ine"),
            rule("n", "", "(?:aa|ee|ii|oo|uu|ää|öö|ie)$", cut=1), rule("n"), rule("a ä", "", "[^aeiouyäö][aeiouyäö]$")]),
        ("cut", "R2", [rule("mpi mpa mpä mmi mma mmä", "", "[^p]o$|[^o]$"), rule("impi impa impä immi imma immä eja ejä")]),
        ("cut", "R1", [rule("i j"), rule("t", "", "[aeiouyäö]$")]),
        ("cut", "R1", [rule(f"{v}{v}", v) for v in "aeiouyäö"]),
        ("cut", "R1", [rule("a ä e i", "", "[^aeiouyäö]$")])],
    "hungarian": [
        ("cut", "RV", [rule("al el", "", "(?:bb|cc|dd|ff|gg|jj|kk|ll|mm|nn|pp|rr|ss|tt|vv|zz)$", cut=1)]),
        ("cut", "RV", [rule(
            "ban ben ba be ra re nak nek val vel tól től ról ről ból ből hoz hez höz nál nél ig at et ot öt ért képp képpen "
            "kor ul ül vá vé onként enként anként ként en on an ön n t")]),
        ("cut", "RV", [rule("á", "a"), rule("é", "e")]),
        ("cut", "RV", [rule("astul estül stul stül"), rule("ástul", "a"), rule("éstül", "e")]),
        ("cut", "RV", [rule("oké öké aké eké ké éi"), rule("áké", "a"), rule("éké", "e")]),
        ("cut", "RV", [rule("ünk unk nk juk jük uk ük om em am m od ed ad öd d ja je a e o"), rule("ánk ájuk ám ád", "a"),
                       rule("énk éjük ém éd", "e")]),
        ("cut", "RV", [rule("jaim jeim aim eim im jaid jeid aid eid id jai jei ai ei i jaink jeink aink eink ink jaitok jeitek "
                            "aitok eitek itok itek jaik jeik aik eik ik"), rule("áim áid ái áink áitok áik", "a"),
                       rule("éim éid éi éink éitek éik", "e")]),
        ("cut", "RV", [rule("ök ok ek ak k"), rule("ák", "a"), rule("ék", "e")])],
    "turkish": [
        ("cut", None, [rule("dır dir dur dür tır tir tur tür yım yim yum yüm sınız siniz sunuz sünüz yız yiz yuz yüz ydı ydi "
                            "ydu ydü ymış ymiş ymuş ymüş ysa yse", "", "^{RV}")]),
        ("cut", None, [rule("dan den tan ten ndan nden da de ta te nda nde nın nin nun nün ya ye na ne yı yi yu yü nı ni nu nü "
                            "yla yle la le ca ce ça çe", "", "^{RV}")]),
        ("cut", None, [rule("ımız imiz umuz ümüz ınız iniz unuz ünüz mız miz muz müz nız niz nuz nüz sı si su sü ım im um üm ın "
                            "in un ün ı i u ü", "", "^{RV}")]),
        ("cut", None, [rule("lar ler", "", "^{RV}")])],
}


def expand(pattern: str, language: str) -> str:
    """A pattern with the names of regions replaced by their patterns."""
    for name, value in REGIONS[language].items():
        pattern = pattern.replace("{" + name + "}", value)
    return pattern


def suffix_pattern(language: str, region: str | None, rules: list[tuple]) -> str:
    """The longest suffix of the rules (group 1): the shortest piece before it, behind the region's prefix."""
    every = sorted({s for r in rules for s in r[0]})
    return f"^{expand('{' + region + '}', language) if region else ''}.*?({'|'.join(every)})$"


def alternation(words: list[str]) -> str:
    """A pattern of the words as a tree of their letters: one branch per first letter, not one per word."""
    branches: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        if w:
            branches.setdefault(w[0], []).append(w[1:])
    tree = [letter + (alternation(rests) if any(rests) else "") for letter, rests in branches.items()]
    return f"(?:{'|'.join(tree)}){'?' if '' in words else ''}"


def suffix_tree_pattern(language: str, region: str | None, rules: list[tuple]) -> str:
    """``suffix_pattern`` with the suffixes as a tree: the same group 1, as both reach the end."""
    return f"^{expand('{' + region + '}', language) if region else ''}.*?({alternation([s for r in rules for s in r[0]])})$"


def _quoted(value: str) -> str:
    return "r'" + value + "'"        # the tables hold neither quotes nor backslashes in strings of SQL


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with a value computed once under a name."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _step(language: str, kind: str, a, b) -> str:
    """One step as SQL over the word ``x``."""
    if kind == "map":
        return f"translate(x, {_quoted(a)}, {_quoted(b)})"
    if kind == "sub":
        return f"regexp_replace(x, {_quoted(a)}, {_quoted(b.replace(chr(92), '$'))})"
    cases = []
    for suffixes, new, tests, cut in b:
        holds = [f"find_in_set(s, {_quoted(','.join(suffixes))}) > 0", *[f"rlike(h, {_quoted(expand(t, language))})" for t in tests]]
        cases.append(f"WHEN {' AND '.join(holds)} THEN concat(left(h, length(h) - {cut}), {_quoted(new)})")
    on_head = _let("left(x, length(x) - length(s))", "h", f"CASE {' '.join(cases)} ELSE x END")
    found = _let(f"regexp_extract(x, {_quoted(suffix_tree_pattern(language, a, b))}, 1)", "s", f"if(s = '', x, {on_head})")
    # a word that ends in no suffix's last letter is told without a pattern
    last = "".join(sorted({s[-1] for r in b for s in r[0]}))
    return f"if(instr({_quoted(last + LINE_ENDS)}, right(x, 1)) = 0, x, {found})"


@functools.lru_cache(maxsize=None)
def stem_sql(language: str) -> str:
    """A lambda function in SQL, from a lower-case word to its stem (one text: built column by column it takes seconds)."""
    word = "x"
    for step in PROGRAMS[language]:
        word = _let(word, "x", _step(language, *step))
    return f"x -> {word}"


def suffix_stem(a: Column, language: str) -> Column:
    """Stems of an array of lower-case tokens."""
    return F.call_function("transform", a, F.expr(stem_sql(language)))


def steps(language: str) -> list:
    """The program of a language as functions of a word (one)."""
    return [lambda x: F.get(suffix_stem(F.array(x), language), F.lit(0))]
