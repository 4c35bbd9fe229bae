"""Template residue, filler, error pages and script notices standing where content should be."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from re import _parser

import ahocorasick
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalmill.operators.skew import salted_left_join
from pedalmill.session import cut, spread

_MARKS = re.compile("[̀-ͯ]")
_INVISIBLE = re.compile("[﻿​‌‍⁠­]")
_SPACES = re.compile("[ \t\x0b\x0c   -   　]+")
_BREAKS = re.compile("\r\n?|[\x85  ]")

# Forms of template fields, by the tools that fill them.
_FIELD = re.compile(
    r"""
      \{\{[^{}\n]{1,60}\}\}            # {{name}}, {{#if x}}
    | \{%[^{}\n]{1,60}%\}              # {% name %}
    | <%[^<>\n]{1,60}%>                # <%= name %>
    | [$#]\{[^{}\n]{1,60}\}            # ${name}, #{name}
    | \{!?[^\W\d][\w. ]{0,38}\}        # {name}, {!name}
    | \{\d\}                           # {0}
    | \[\[[^\[\]\n]{1,60}\]\]          # [[name]]
    | <<[^<>\n]{1,60}>>                # <<name>>
    | «[^\s«»][^«»\n]{0,38}(?<=\S)»    # «name»
    | \*\|[^|*\n]{1,60}\|\*            # *|name|*
    | __[^\W\d_][^\W_]*(?:_[^\W_]+)*__ # __NAME__
    | %[^\W\d_][\w.]{1,40}%           # %NAME%
    | %\d+\$[sdf]                      # %1$s
    | %\([^\W\d]\w*\)[sdf]             # %(name)s
    | @Model\.\w+(?:\.\w+)*            # @Model.name
    | (?<![\w$])\$\$?[^\W\d][\w.]{1,38}\$(?!\w) # $name$
    | \$\$[^\W\d]\w{2,38}              # $$NAME
    | \[[xX]{2,}\]                     # [xxx]
    | \bXX/XX/XX(?:XX)?\b              # a date not filled in
    | \[(?!object\ object\])[^\W\d](?=[^\[\]\n]*[ _/])[^\[\]\n]{1,38}\]  # [Your company], [customer_name]; one word is a word in brackets
    | (?-i:\[[A-Z][A-Z0-9]{1,38}\])     # [CODE]
    | <(?!/?(?:b|i|u|p|a|br|hr|em|li|ul|ol|td|tr|th|tt|h[1-6]|div|span|img|font|table|body|html|head|strong|script|style|noscript)\b)[^\W\d][\w./ ]{0,38}> # <name>, <insert price>
    """,
    re.X | re.I,
)
_FILL_IN = re.compile(r"\((?:dien|nhap|chen|insert|enter|fill in|type) [^()\n]{1,40}(?:vao day|here|o day)\)")

# What a program prints for a value it does not have, where a value should be.
_EMPTY = re.compile(
    r"\[object object\]|\b(?:dear|hello|hi|xin chao|chao|kinh gui|bonjour|cher|chere) (?:null|undefined|none|nan)\b"
    r"|\b(?:undefined|null)\b(?! index| reference| pointer)|\bco none\b|\bcon none\b|(?:gia|price|total|tong|cong)\s*:\s*(?:nan|none|null)\b"
)

# Filler. Words of the pseudo-Latin that fills layouts, and of the keyboard.
_LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis "
    "nostrud ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur "
    "excepteur sint occaecat cupidatat proident culpa officia deserunt mollit anim laborum pellentesque sodales vestibulum numquam porta "
    "lacinia gravida mondus vadis gravem pellex consetum sodal amarit elitra velum feria lacinus tibera oditur".split()
)
_KEYS = frozenset("abc asdf asdfgh qwe qwerty xyz aaa bbb xxx test thu 123 1234 12345 foo bar blah zzz".split())
_SAMPLE = re.compile(
    r"^(?:heading|tieu de|muc mau|dong thu|item|muc|section|doan mau|paragraph) \d+[\s.!…]*$|^(?:todo|tbd|fixme)\b|^coming soon\b|^\(?(?:trong|empty)\)? - "
    r"|noi dung mau|doan van mau|van ban giu cho|text goes here|sample text|placeholder text|mo ta san pham o day|cho phong \w+ viet"
    r"|^(?:trang|muc|phan|noi dung)(?: nay)? dang (?:duoc )?(?:hoan thien|soan thao|cap nhat|xay dung)|^\W*(?:\w+ ){1,3}dang (?:duoc )?bien soan\b|^\W*(?:\w+ ){1,4}se (?:duoc )?(?:bo sung|cap nhat) sau\b|^dang (?:cap nhat|hoan thien)(?: noi dung)?[\s.!…]*$"
    r"|(?:noi dung|(?:phan )?mo ta|thong so|hinh anh)(?: san pham)? (?:chua co\b|se (?:duoc )?(?:bo sung|cap nhat))"
    r"|(?:content|specs?|specifications?|description|details|copy|photos?) (?:is |are |will )?(?:coming soon|to be added|follow\b|to follow|goes here|go here)"
    r"|texte a venir|此处填写|示例文本|占位文字"
)
_RUN = re.compile(r"x{8,}")

# How programs, servers and access checks speak to a reader. Plain, lower case.
_NOTICE = re.compile(
    r"""
      ^\W*(?:http|error|erreur|loi|su\ co|status|ma\ loi|error\ code)\s*(?:code)?\s*[:#-]?\s*e?\d{3}\b
    | ^\W*\d{3}\s*[-:–]?\s+(?:internal|bad|not|service|gateway|forbidden|unauthorized|trang|loi|page|the|this|we\ |sorry|duong|muc|dia|there|su\ |he\ )\b
    | internal\ server\ error | bad\ gateway | service\ (?:temporarily\ )?unavailable | gateway\ time-?out | upstream\ closed | cache\ miss\ \d
    | \b(?:page|resource|document|item|file|address|site|product)\s(?:you\s\w+\s)?(?:is\snot\savailable|does\snot\sexist|could\snot\sbe\s(?:loaded|found)|cannot\sbe\s(?:loaded|found)|not\sfound|has\s(?:been\s)?(?:moved|removed|deleted)|no\slonger\sexists)
    | (?:we|you)\s(?:can\s?not|could\snot|can't|couldn't)\sfind\s(?:this|that|the)\s | there\sis\snothing\sat\s
    | page\sintrouvable | le\slien\sest\speut-etre\srompu | service\sindisponible | reessayez\splus\stard | acces\s(?:refuse|interdit) | une\serreur\s(?:est|s'est)\s
    | 页面不存在 | 页面已被 | 服务器错误 | 网络超时 | 请稍后再试 | 无法访问 | 访问被拒绝 | 找不到 .{0,6}页
    | trang\s(?:nay\s|ban\s\w+\s)?(?:khong\ston\stai|khong\stim\sthay|da\sbi\sxoa) | khong\stim\sthay\strang | duong\sdan\s(?:sai|khong\sdung|khong\shop\sle) | (?:dia\schi|muc)\s(?:nay|can\sxem)\sda\s(?:doi\sten|bi\sxoa|khong)
    | (?:san\spham|mat\shang)\s(?:nay\s)?(?:khong\ston\stai|da\sngung\skinh\sdoanh|da\sbi\s(?:xoa|go)) | khong\stai\sduoc\s(?:noi\sdung|trang|du\slieu)
    | (?:he\sthong|dich\svu|may\schu)\s(?:dang\sban|tam\sngung|dang\sbao\stri|qua\stai|gap\ssu\sco) | xin\squay\slai\ssau | (?:website|trang\sweb|trang|cong\s\w+\s\w+|ung\sdung)\sdang\s(?:duoc\s)?(?:bao\stri|nang\scap) | dang\s(?:bao\stri|nang\scap),\s(?:du\skien|moi|xin|vui)
    | da\sxay\sra\s(?:loi|su\sco) | something\swent\swrong | co\sgi\sdo\skhong\son | an\s(?:unexpected\s)?error\s(?:has\s)?occurred | unexpected\serror
    | het\sthoi\sgian\scho | (?:ket\snoi|yeu\scau)\s(?:da\s)?qua\shan | time-?out\s(?:khi|trong|while|error) | request\stimed\sout | f5\sde\sthu\slai
    | (?:phien|your)\s(?:(?:dang\snhap|lam\sviec)\s|session\s)(?:cua\sban\s)?(?:da\shet\shan|het\shan|(?:has\s)?(?:expired|timed\sout)) | vui\slong\sdang\snhap\s(?:lai|de) | hay\sdang\snhap\sde | ^\W*log\sin\sagain | please\s(?:log|sign)\sin\s(?:again|to\s(?:continue|proceed|view|access|see)\s(?:this|the)\s(?:page|content|site)\b|first)
    | rate\slimit\s(?:reached|exceeded) | too\smany\srequests | slow\sdown\sand\stry | ban\sthao\stac\squa\snhanh | ^\W*thu\slai\ssau\s\d+\sgiay | ^\W*retry\safter\s\d
    | truy\scap\s(?:da\s)?bi\s(?:tu\schoi|chan)(?!\s(?:o|tai|nen)\b) | yeu\scau\s(?:cua\sban\s)?(?:da\s)?bi\s(?:chan|tu\schoi) | access\s(?:is\s)?denied | ^\W*forbidden\b | permission\sdenied
    | checking\syour\sbrowser | verify(?:ing)?\s(?:that\s)?you\sare\s(?:a\s)?human | dang\skiem\stra\strinh\sduyet | xac\s(?:minh|nhan)\s(?:rang\s)?ban\s(?:la\snguoi|khong\sphai) | nhap\sma\strong\shinh | danh\sdau\svao\so\s | tick\sthe\sbox | khong\sphai\s(?:la\s)?(?:robot|nguoi\smay) | complete\sthe\scaptcha | 请验证 | 人机验证
    | traceback\s\(most\srecent | ^\W*file\s['"]?\S+\.py['"]?,\sline\s\d | \b(?:fatal\serror|uncaught\sexception|parse\serror)\b | ^\W*(?:warning|notice):\s | undefined\s(?:index|variable|offset) | \bon\sline\s\d+\s*\W*$
    | nullreferenceexception | \bjava\.[a-z]+\.\w+ | \b\w+(?:exception|error):\s | stack\somitted | server\serror\sin\s | cannot\sconnect\sto\s(?:the\s)?database | object\sreference\s(?:is|not) | out\sof\smemory\sin\s
    | \b(?:enable|turn\son|allow|activate|switch\son|activez|activer|autoriser)\s(?:java\s?script|scripts?\b|js\b)
    | \b(?:java\s?script|scripting|scripts?|js)\s(?:is|are|seems|appears|seem|appear)\s(?:to\sbe\s)?(?:required|off|disabled|blocked|needed|turned\soff)
    | (?:will\snot\sload|works?\s(?:best|only)|does\snot\swork)\s(?:with(?:out)?|unless|if)\s(?:java\s?script|scripts?|js)\b | \(scripts?\s(?:is|are)\srequired\) | \bnoscript\b
    | (?:trinh\sduyet|browser)\s(?:cua\sban\s|nay\s|dang\s)*(?:khong\sho\stro|chua\sbat|da\stat|chan)\s(?:java\s?script|script|ma\schay|ma\skich\sban) | kiem\stra\sda\sbat\sjava\s?script
    | (?:bat|mo|kich\shoat|cho\sphep)\s(?:java\s?script|script)\s(?:tren|roi|de|trong) | ^\W*(?:vui\slong|xin|xin\shay|hay|ban\scan)\s(?:hay\s)?(?:bat|mo|kich\shoat|cho\sphep)\s(?:java\s?script|script|ma\skich\sban|ma\schay)
    | (?:enable|allow|accept|turn\son)\scookies\b | cookies\s(?:are|must\sbe)\s(?:disabled|required|enabled)
    | \b(?:404|500|502|503)\b\W{0,3}(?:not\sfound|pagina|seite|страница|ページ|erro\b|fehler|ошибка)
    | pagina\s(?:solicitada\s|richiesta\s|que\s\w+\s)?(?:no\s(?:existe|encontrada|disponible|se\s(?:encuentra|ha\sencontrado))|nao\s(?:existe|encontrada|foi\sencontrada)|non\s(?:esiste|trovata|disponibile))
    | (?:no\sse\s(?:encontro|pudo\s(?:encontrar|cargar))|nao\sfoi\spossivel\s(?:encontrar|carregar)|impossibile\s(?:trovare|caricare))\s(?:la|a)\spagina | error\sinterno\sdel\sservidor | erro\sinterno\sdo\sservidor | errore\sinterno\sdel\sserver | acceso\sdenegado | acesso\snegado | accesso\snegato
    | (?:active|habilite|activa|habilita|ative|abilita|abilitare)\sjava\s?script | seite\s(?:wurde\s)?nicht\s(?:gefunden|verfugbar) | interner\sserverfehler | zugriff\sverweigert | java\s?script\s(?:aktivieren|ist\s(?:deaktiviert|erforderlich)) | aktivieren\ssie\s(?:bitte\s)?java\s?script
    | ページが見つかりません | お探しのページは | サーバーエラー | アクセスが拒否 | java\s?scriptを有効 | 페이지를\s찾을\s수\s없습니다 | 자바스크립트를 | страница\sне\sнаидена | страница\sне\sнайдена | включите\sjava\s?script | доступ\sзапрещ[её]н | внутренняя\sошибка\sсервера
    | (?:启用|需要开启|开启|打开)\s?java\s?script | trinh\sduyet\skhong\sho\stro\sjava
    """,
    re.X,
)
# By these a sentence tells of such text rather than being it.
_TOLD = re.compile(
    r"\b(?:it worked|works? again|da huong dan|da giai thich|nghia la gi|nhap giup|xem giup|in lai giup|bat lai|da cap lai|asked whether|vao lai duoc"
    r"|bao loi|ghi tay|gave error|phai gui don)\b"
)
# By these a sentence explains a template's field.
_EXPLAINED = re.compile(r"\b(?:mau thu|form prints|fix the form|field is blank|may tu dien|sua mau|phai duoc thay|giu nguyen|placeholder|merge field)\b")
# Lines of a page's frame.
_FRAME = re.compile(r"^(?:home > .*|menu\b.*|dang nhap . dang ky|hotline .*|© .*|trang chu \| .*)$")

_SENTENCE = re.compile(r"\n+|(?<=[.!?。…])\s+")
_QUOTED = re.compile(r'"[^"\n]*"|“[^”\n]*”')
_LABEL = re.compile(r"\W*[^\W\d_]+(?: [^\W\d_]+){0,3}: ?")
_TRACE_FILE = re.compile(r'(?i)\b(file) "([^"\n]{1,60})"')
_WORD = re.compile(r"[^\W_]+")


def required(pattern: re.Pattern) -> frozenset[str]:
    """Literals of which every match of ``pattern`` holds one, as long as can be; empty where it has none of three
    letters, as when it ignores case."""

    def better(a: frozenset[str], b: frozenset[str]) -> frozenset[str]:
        return max(a, b, key=lambda s: min(map(len, s), default=0))

    def of(items: object) -> frozenset[str]:
        best: frozenset[str] = frozenset()
        run = ""
        for op, arg in [*items, (None, None)]:
            name = str(op)
            if name == "LITERAL":
                run += chr(arg)
                continue
            if run:
                best, run = better(best, frozenset([run])), ""
            if name == "SUBPATTERN":
                best = better(best, of(arg[3]))
            elif name in ("MAX_REPEAT", "POSSESSIVE_REPEAT", "MIN_REPEAT") and arg[0] > 0:
                best = better(best, of(arg[2]))
            elif name == "BRANCH":
                each = [of(x) for x in arg[1]]
                if all(each):
                    best = better(best, frozenset().union(*each))
        return best

    found = of(_parser.parse(pattern.pattern, pattern.flags)) if not pattern.flags & re.I else frozenset()
    return found if found and min(map(len, found)) >= 3 else frozenset()


class Sieve:
    """A pattern that is tried only on texts with one of the literals that its matches require; finds the same."""

    def __init__(self, pattern: re.Pattern) -> None:
        self.pattern = pattern
        self.literals = required(pattern)
        self.found = ahocorasick.Automaton()
        for word in self.literals:
            self.found.add_word(word, word)
        if self.literals:
            self.found.make_automaton()

    def search(self, text: str) -> bool:
        if self.literals and next(self.found.iter(text), None) is None:
            return False
        return bool(self.pattern.search(text))


_NOTICES, _SAMPLES, _EMPTIES = Sieve(_NOTICE), Sieve(_SAMPLE), Sieve(_EMPTY)
#: One of these is in every template field.
_FIELD_SIGNS = re.compile(r"[{\[«@]|<[%<\w]|\*\||__|%[\d(\w]|\$\w|\$\$|XX/XX", re.I)

#: Words of a body below which it is low in information.
LOW_WORDS = 25
#: Documents of a host under different titles that must share a low-information body.
COPIES = 3
#: Mean log-odds of a body's terms, between bodies in which a detector found something and the others, from which on a
#: shared body is taken for residue.
ODDS = 1.0


def tidy(text: str) -> str:
    """``text`` composed, without invisible characters, its blanks and line ends each one space or newline."""
    return _SPACES.sub(" ", _INVISIBLE.sub("", _BREAKS.sub("\n", unicodedata.normalize("NFC", text))))


def plain(text: str) -> str:
    """Lower case without accents, đ as d."""
    return unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFD", text.lower()))).replace("đ", "d")


def unquoted(text: str) -> str:
    """``text`` without what its sentences quote: spans in double quotes that words lead into or follow. A
    template's field in quotes that is all that a label at the start of a line has is no quotation."""
    text = _TRACE_FILE.sub(r"\1 '\2'", text)

    def mask(m: re.Match) -> str:
        before = text[max(0, m.start() - 40) : m.start()].rpartition("\n")[2]
        after = text[m.end() : m.end() + 40].partition("\n")[0]
        if _LABEL.fullmatch(text[text.rfind("\n", 0, m.start()) + 1 : m.start()]) and _FIELD.fullmatch(m.group()[1:-1].strip()):
            return m.group()
        led = re.search(r"[^\W\d_]{2,}[,:]? $", before) or re.match(r"[,.]? (?:[^\W\d_]+ ){1}[^\W\d_]+", after)
        return ' "" ' if led else m.group()

    return _QUOTED.sub(mask, text)


def _filler(sentence: str) -> bool:
    words = _WORD.findall(sentence)
    latin = keys = 0
    for w in words:
        latin = latin + 1 if w in _LATIN else 0
        keys = keys + 1 if w in _KEYS else 0
        if latin >= 4 or keys >= 4:
            return True
    if 1 < len(words) <= 3 and all(w in _LATIN for w in words):
        return True
    letters = [w for w in words if not w.isdigit()]
    if len(letters) >= 6 and len(set(letters)) <= 3:
        return True
    return _SAMPLES.search(sentence) or bool(_RUN.search(sentence))


def read(text: str | None) -> tuple[str, str]:
    """What the detectors look at: ``text`` tidy and without quotations, and its plain form; '' for null."""
    whole = unquoted(tidy(text)) if text else ""
    return whole, plain(whole)


def strong_reasons(text: str | None) -> list[str]:
    """Which kinds of residue ``text`` holds: FIELD, EMPTY_VALUE, FILLER, NOTICE. None for null and blank texts."""
    return reasons_of(*read(text))


def reasons_of(whole: str, low: str) -> list[str]:
    found: list[str] = []
    fields = [s for s in _SENTENCE.split(whole) if _FIELD.search(s)] if _FIELD_SIGNS.search(whole) else []
    if any(not _EXPLAINED.search(plain(_FIELD.sub(" ", s))) for s in fields):
        found.append("FIELD")
    for s in _SENTENCE.split(low):
        s = s.strip()
        if not s:
            continue
        if "FIELD" not in found and _FILL_IN.search(s) and not _EXPLAINED.search(_FILL_IN.sub(" ", s)):
            found.append("FIELD")
        if "EMPTY_VALUE" not in found and _EMPTIES.search(s) and not _TOLD.search(s):
            found.append("EMPTY_VALUE")
        if "FILLER" not in found and _filler(s):
            found.append("FILLER")
        if "NOTICE" not in found and _NOTICES.search(s) and not _TOLD.search(s):
            found.append("NOTICE")
    return found


def page_evidence(low: str) -> tuple[int | None, int | None, list[str] | None]:
    """(body, title, terms): hashes of body and title and the body's terms, of a plain text whose title has no term in
    common with its low-information body; (None, None, None) else, and where the body tells of such text. Numbers
    count as equal, a page's frame not."""
    lines = [s for s in (x.strip() for x in low.split("\n")) if s]
    body = [s for s in lines[1:] if not _FRAME.match(s)]
    joined = re.sub(r"\d+", "0", " ".join(body))
    words = set(_WORD.findall(joined))
    if not words or len(words) > LOW_WORDS or _TOLD.search(joined) or words & {w for w in _WORD.findall(lines[0]) if len(w) > 2}:
        return None, None, None
    return xxhash.xxh64_intdigest(joined) >> 1, xxhash.xxh64_intdigest(lines[0]) >> 1, sorted(words)


def _look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = [(reasons_of(whole, low), *page_evidence(low)) for whole, low in map(read, texts)]
        # made as integers from the start: a column with gaps would else go through floats and lose digits
        body, title = (pd.array([r[k] for r in rows], dtype="Int64") for k in (1, 2))
        yield pd.DataFrame({"reasons": [r[0] for r in rows], "body": body, "title": title, "terms": [r[3] for r in rows]})


def page_bodies(seen: DataFrame) -> DataFrame:
    """(host, body, titles, odds) of the low-information bodies unlike their titles: under how many titles the host
    gives it, and the mean log-odds of its terms.

    A term's odds are those of the bodies with it in which a detector found something, against all others, each body
    of a host counted once; so what error pages of these very hosts say is learned from those that the detectors know.
    All is counted over all documents and joined by keys; a term that a third of the bodies has is salted.
    """
    titles = seen.where("body is not null").groupBy("host", "body", "title").agg(F.max(F.size("reasons") > 0).alias("found"), F.first("terms").alias("terms"))  # equal for equal bodies
    bodies = cut(titles.groupBy("host", "body").agg(F.count(F.lit(1)).alias("titles"), F.max("found").alias("found"), F.first("terms").alias("terms")).withColumn("k", F.xxhash64("host", "body")))
    sizes = bodies.agg(F.count_if("found").alias("all_found"), F.count_if(~F.col("found")).alias("all_other"))  # one row
    terms = bodies.select("k", "found", F.explode("terms").alias("term"))
    odds = terms.groupBy("term").agg(F.count_if("found").alias("yes"), F.count_if(~F.col("found")).alias("no")).crossJoin(F.broadcast(sizes))
    share = lambda n, of: (F.col(n) + 0.5) / (F.col(of) + 1.0)
    odds = odds.select("term", F.log(share("yes", "all_found") / share("no", "all_other")).alias("odds"))
    scored = salted_left_join(terms.select("k", "term"), odds, ["term"], ["k"]).groupBy("k").agg(F.avg("odds").alias("odds"))
    return bodies.join(scored, "k").select(F.col("host").alias("h"), F.col("body").alias("b"), "titles", "odds")


def find_residue(rows: DataFrame, ident: str, text: str, host: str, copies: int = COPIES) -> DataFrame:
    """(ident, reasons, host, mismatched, titles) of the rows of ``rows`` whose ``text`` is, or holds, something that
    stands for content.

    FIELD, EMPTY_VALUE, FILLER and NOTICE are found in the text itself, sentence by sentence, unless the
    sentence quotes, reports or explains it. DUPLICATED is found over all rows: a body low in information, without a
    term of its title, that the same host gives under ``copies`` different titles at least, and whose terms speak as
    the bodies do in which a detector found something (``page_bodies``). ``mismatched`` tells whether the body is such a
    low one unlike its title, ``titles`` under how many titles its host gives it (null where it is not). Null, empty and
    blank texts have no reasons. Repeated rows come out as often as they come in; hosts may be null. Each text is
    looked at once.
    """
    narrow = spread(rows.select(F.col(ident).alias("id"), F.col(host).alias("host"), F.col(text).alias("text")))
    seen = narrow.withColumn("r", F.pandas_udf(_look, "struct<reasons:array<string>,body:bigint,title:bigint,terms:array<string>>")("text"))
    # used twice; of the texts only this is kept
    seen = cut(seen.select("id", "host", "r.*").where((F.size("reasons") > 0) | F.col("body").isNotNull()))
    told = page_bodies(seen).withColumn("shared", (F.col("titles") >= copies) & (F.col("odds") >= ODDS))
    joined = seen.join(told, F.col("host").eqNullSafe(F.col("h")) & (F.col("body") == F.col("b")), "left")
    shared = F.coalesce("shared", F.lit(False))
    reasons = F.when(shared, F.array_append("reasons", F.lit("DUPLICATED"))).otherwise(F.col("reasons"))
    return joined.select(F.col("id").alias(ident), reasons.alias("reasons"), "host", F.col("body").isNotNull().alias("mismatched"), "titles").where(F.size("reasons") > 0)
