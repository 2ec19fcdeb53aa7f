"""Problem 8: template residue and messages of a site in place of text.

Character n-gram models (orders 1, 2, 4 and 6, hashed into tables of fixed size) are fitted for filler, for
notices (error messages, script notices), for unfilled slots and for natural prose; in every text,
likelihood-ratio windows localise what is likelier under one of the first three.  Filler counts where a run of
windows is long enough, a notice where windows cover most of the text, a slot where the ratio summed over it
(the best window that ends at a character) is high enough; a following check can only reject a slot (quoted, or
a tag, an aside, a word in brackets), none is found by it.

The seeds below are general wordings (of web servers, browsers, programming languages, page layout programs);
the wordings of the data are learned.  Every distinct segment of all texts is counted once, with the company it
keeps: a segment that stands among segments near the seeds of notices is a notice, one that stands among others
is natural, what always stands alone is left open at first.  Models fitted on these labels label the segments
anew, and models fitted on those judge.  An n-gram of one or two natural segments only counts as unseen (absolute
discounting), so no wording vouches for itself.

Scale: texts are read twice (segments, judging); segments are counted in tasks and summed by one shuffle;
n-grams are summed by bin, and at most one row a bin, of the tables' fixed number, reaches the driver.  The models
(about 20 MB, independent of the data) are broadcast, and every text is judged whole in one map without a shuffle.

Defined results: null, empty and blank texts are no case.  Bracketed words, prices, tags and quoted mentions
are no slots.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .canonical import canonical
from .common import arrow_map, arrow_stream, cut, portions, ship

ORDERS = (1, 2, 4, 6)
BITS = (12, 18, 19, 20)  # of the table of each order
LEAST_P = 1e-4  # so that one strange character decides nothing
PAD = 40  # characters of no class between texts that are read together: twice WINDOW, so that windows never meet
DISCOUNT = 2  # natural segments that may hold an n-gram by chance
TRUST = (4.0, 1.0, 1.0, 0.5)  # of each class: how often a context must be seen to outweigh the shorter one
MOST_HELD = 150_000  # segments a task counts before it hands them on
COUNTED = 1_000_000  # characters whose n-grams are counted at a time
ROUNDS = 2
PORTION = 300_000  # characters judged at a time
NEAR = 0.3  # share of the n-grams of a segment that stand in seeds of notices
ALONE = 0.6  # that share of a segment that has no company
FAR = 0.15  # that share of a segment which may be natural
ANCHORED = 0.2  # share of the company of a segment that is near the seeds
SURE, SURE_ALONE = 0.25, 1.0  # nats a character for a label when segments are labelled anew; without company
MARGIN = (0.0, 0.6, 0.8)  # nats a character, of each class
WINDOW = 20  # characters of a likelihood-ratio window
FILLER_RUN = 22  # characters of filler that take up room
LEAST_RUN = 12  # characters of filler that make a short text
NOTICE_COVERAGE = 0.6
SLOT_NATS = 5.5  # summed over a slot
MAYBE_SLOT_NATS = 4.0  # summed over what natural prose isn't learned from
PRIOR = 16.0  # nats in favour of natural prose when segments are labelled
VOUCHED = 8  # different companions that make a segment natural beyond chance
COMPANION = 12  # characters of a segment that counts as company
NATURAL, FILLER, NOTICE, SLOT = range(4)
ENDS = (". ", "! ", ". ", "... ", ". ", ", ", ". ", "? ", ". ", ": ", "")  # put behind segments, which are known without their marks

# What the models start from.
LATIN_SEEDS = (
    "lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.",
    "sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam, eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo. nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt.",
    "at vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis praesentium voluptatum deleniti atque corrupti quos dolores et quas molestias excepturi sint occaecati cupiditate non provident, similique sunt in culpa qui officia deserunt mollitia animi. temporibus autem quibusdam et aut officiis debitis aut rerum necessitatibus saepe eveniet.",
    "pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas. vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae. curabitur pretium tincidunt lacus, nulla gravida orci a odio, nullam varius turpis et commodo pharetra. cum sociis natoque penatibus et magnis dis parturient montes, nascetur ridiculus mus.",
    "nullam quis risus eget urna mollis ornare vel eu leo. duis mollis est non commodo luctus, nisi erat porttitor ligula, eget lacinia odio sem nec elit. fusce dapibus, tellus ac cursus commodo, tortor mauris condimentum nibh, ut fermentum massa justo sit amet risus. etiam porta sem malesuada magna mollis euismod. morbi leo risus, porta ac consectetur ac, vestibulum at eros. praesent commodo cursus magna, vel scelerisque nisl consectetur et. aenean eu leo quam, sed felis arcu facilisis.",
)
FILLER_SEEDS = (
    "this is a sample text. sample text only. dummy text. dummy copy. filler text, replace me. placeholder. this is a placeholder, change it later. insert your text here. enter text. write something here. content goes here. copy goes here. body copy. your review here. text to follow. coming soon. to be written. to do: write copy. todo write. tbd. tbc. n.n.",
    "dies ist ein blindtext. nur ein platzhalter. ein mustertext. beispieltext einfügen. bitte text einsetzen. hier text eingeben. text folgt. text wird noch ergänzt. fülltext. dummytext. inhalt folgt in kürze. ihre bewertung hier. noch zu ersetzen.",
    "ceci est un faux texte. texte factice. texte de remplissage. exemple de texte. insérez votre texte ici. saisir le texte. texte à venir. à compléter. à remplacer. contenu à insérer. votre avis ici.",
    "este es un texto simulado. texto provisional. ejemplo de texto. un texto de muestra. inserte su texto. escriba aquí. texto por completar. contenido de relleno. pendiente de sustituir. su reseña aquí.",
    "dit is een proeftekst. een voorbeeld van tekst. plaatshouder. vul hier uw tekst in. tekst volgt. nog in te vullen. nog vervangen. opvulling. dummytekst. uw beoordeling hier.",
    "это образец текста. рыба текст. текст заглушка. вставьте текст сюда. введите текст. текст появится позже. заполнитель. временный текст. нужно заменить. ваш отзыв здесь. пример.",
    "asdf qwer zxcv yxcv jkl uiop qwerty qwertz azerty asdfgh фыва йцукен ячсм foo bar baz qux foobar bla bla blah xxx test test testing abc abc 000",
)
NOTICE_SEEDS = (
    "000 bad request. 000 unauthorized. 000 forbidden. 000 request timeout. 000 gone. 000 gateway timeout. http status 000. http error code 000. error code: 000.",
    "the requested url was not found on this server. the page cannot be found. this page does not exist. no such page. the page you are looking for might have been moved or deleted. check the url and try again.",
    "the server encountered an error and was unable to complete your request. the server is temporarily unable to service your request due to maintenance downtime or capacity problems. please try again in a few minutes. an error has occurred. sorry for the inconvenience. we will be back soon. contact the site administrator.",
    "access to this page has been denied. you are not authorized to access this page. permission denied. too many attempts. rate limit exceeded. your request was blocked.",
    "this site cannot be reached. unable to connect. the connection has timed out. the proxy server is refusing connections. upstream timed out. gateway error. no response from server. the network connection was interrupted. check your internet connection. click here to retry.",
    "javascript is required. this site requires javascript. you need to enable javascript to run this app. javascript is turned off. your browser does not support javascript. enable javascript and cookies to continue. please turn javascript on. scripts are blocked by your browser. allow scripts and refresh. noscript.",
    "failed to load content. failed to load reviews. unable to display this item. this item is no longer available. loading, please wait. cannot be shown.",
    "your session timed out. please log in. you have been logged out. login required. sign up | log in | help | contact. home | products | sign in. main page.",
    "uncaught exception. unhandled exception. exception in thread \"main\" java.lang.illegalargumentexception at org.example.main.run(main.java:000). caused by: java.io.ioexception. parse error: syntax error in /var/www/index.php on line 000. undefined variable. warning: include failed. traceback: file \"main.py\", line 000, in module. indexerror: list index out of range. typeerror: cannot read properties of undefined. syntaxerror: unexpected token in json. segfault. core dumped. request-id: 000. trace id 000. reference number 000.",
    "die seite wurde nicht gefunden. diese seite gibt es nicht. die adresse wurde nicht gefunden. der server ist derzeit nicht erreichbar. ein fehler ist aufgetreten. fehlercode 000. interner fehler. zeitüberschreitung der anfrage. keine verbindung zum server. verbindung unterbrochen. wartung: der dienst ist vorübergehend nicht verfügbar. versuchen sie es später noch einmal. seite neu laden. sie haben keine berechtigung. zugriff gesperrt. kein zugriff. dieser inhalt ist nicht mehr verfügbar. laden fehlgeschlagen. startseite.",
    "javascript ist deaktiviert. bitte schalten sie javascript ein. ihr browser blockiert skripte. für diese seite wird javascript benötigt. aktivieren sie skripte im browser und laden dann neu. ihre anmeldung ist abgelaufen, bitte neu anmelden. bitte einloggen.",
    "la page est introuvable. cette page n’existe pas. l’adresse n’a pas été trouvée. le serveur est actuellement indisponible. une erreur est survenue. code d’erreur 000. erreur interne. délai d’attente dépassé. impossible de se connecter au serveur. connexion perdue. maintenance en cours. réessayez ultérieurement. actualisez la page. vous n’avez pas l’autorisation. accès interdit. ce contenu n’est plus disponible. échec du chargement. requête échouée. page d’accueil.",
    "javascript est désactivé. merci d’activer javascript. les scripts sont bloqués par votre navigateur. cette page nécessite javascript. activez les scripts et rechargez. votre session est terminée. connectez-vous.",
    "no se encuentra la página. esta página no existe. no se encontró la dirección. el servidor no está disponible. ha ocurrido un error. código de error 000. error interno. tiempo de espera agotado. no se puede conectar con el servidor. conexión interrumpida. en mantenimiento. vuelva a intentarlo. actualice la página. no tiene permiso. acceso prohibido. este contenido ya no está disponible. no se pudo cargar. solicitud fallida. ir al inicio.",
    "javascript está desactivado. habilite javascript. su navegador bloquea los scripts. esta página requiere javascript. active los scripts y vuelva a cargar. la sesión ha terminado. iniciar sesión.",
    "de pagina kan niet worden gevonden. deze pagina bestaat niet. het adres is niet gevonden. de server is niet bereikbaar. er ging iets mis. foutcode 000. interne fout. time-out van het verzoek. geen verbinding met de server. verbinding verloren. onderhoud. probeer het opnieuw. vernieuw de pagina. u heeft geen toestemming. geen toegang. deze inhoud is niet meer beschikbaar. kan niet worden geladen. naar de homepage.",
    "javascript staat uit. zet javascript aan. uw browser blokkeert scripts. deze pagina vereist javascript. sta scripts toe en laad opnieuw. uw sessie is beëindigd. log in.",
    "такой страницы нет. адрес не найден. сервер недоступен. возникла ошибка. код ошибки 000. внутренняя ошибка. время ожидания истекло. нет соединения с сервером. соединение потеряно. технические работы. попробуйте ещё раз. перезагрузите страницу. нет прав доступа. доступ закрыт. этот материал больше не доступен. не удалось загрузить. ошибка запроса. на главную страницу.",
    "javascript отключён. javascript не работает. ваш браузер блокирует скрипты. для этой страницы нужен javascript. разрешите скрипты и перезагрузите. сеанс завершён. войдите в систему.",
)
# How template languages mark slots.
SLOT_FORMS = ("{{%s}}", "{{ %s }}", "{%s}", "${%s}", "%%%s%%", "<%%= %s %%>", "<%s>", "[%s]", "[[%s]]", "[%s ...]", "__%s__", "#%s#", "@@%s@@", "«%s»")
BARE_SLOTS = ("xxxx", "%s", "%d", "%0$s")

# Tags and bracketed words that are no slots.
TAGS = "a|abbr|b|big|blockquote|body|br|center|code|div|em|font|form|h[0-6]|head|hr|html|i|img|input|li|link|meta|ol|p|pre|s|script|small|span|strike|strong|style|sub|sup|table|tbody|td|th|title|tr|u|ul"
ASIDES = "sic|edit|update|note|ok|lol|spoiler|link|deleted|removed|video|foto|photo|image|img|bild|ad|anzeige|hier|here"

_NAME = r"[^\W_](?:[\w.\- ]*\w)?(?: ?\.\.\.)?"
# The check behind the windows: what is no placeholder by its form is rejected.
_SLOT = re.compile(
    "|".join(
        (
            r"\{\{ ?[^{}\n]{1,60} ?\}\}",
            r"\$\{[^{}\n]{1,60}\}",
            r"<%=?[^%<>\n]{1,60}%>",
            rf"\[\[ ?{_NAME} ?\]\]",
            rf"\[%{_NAME}%\]",
            r"(?<!\{)\{ ?(?:\d{1,2}|[^\W\d_][\w.\- ]{1,50}) ?\}(?!\})",
            rf"(?<![\w@])@@?{_NAME}@@",
            r"(?<!\w)__[^\W_](?:[\w.\- ]*[^\W_])?__(?!\w)",
            r"(?<![\w#])##?[^\W_][\w.\-]*##?(?!\w)",
            r"(?<![\w%])%[^\W\d_][\w.\-]+%(?!\w)",
            r"(?<![\w%])%(?:\d\$)?[sd](?!\w)",
            r"(?<![^\W_])[Xx]{4,}(?![^\W_])",
            rf"<(?!(?:{TAGS})\b)[^\W\d_][\w.\-]*(?: [\w.\-]+){{0,4}}>",
            rf"(?<!\[)\[ ?(?!(?:{ASIDES})\])[^\W\d_][\w.\- ]{{2,50}}(?: ?\.\.\.)? ?\](?!\])",
            r"«[^\W\d_]\w*»",
        )
    ),
    re.IGNORECASE,
)
_QUOTED = re.compile(r"“[^“”„\n]{1,200}[”“]|„[^„“”\n]{1,200}[“”]|« [^«»\n]{1,200} »|«(?=[^»\n]* )[^«»\n]{1,200}»|\"[^\"\n]{1,200}\"|‘[^‘’\n]{1,200}’|`[^`\n]{1,200}`")
_TAG = re.compile(rf"</?(?:{TAGS})\b[^<>]*>", re.IGNORECASE)
_ID = re.compile(r"\b(?=[a-f]*0)[0a-f]{5,}\b")  # record and request ids
_DIGIT = re.compile(r"\d")
_SEGMENT = re.compile(r"(?<=[.!?…])\s+|\n+|\s[|–—-]\s")
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    """What the models read: consistent characters, lower case, digits as 0, tags as blanks; as long as the
    consistent form of the text."""
    out = canonical(text)
    if "<" in out:
        out = _TAG.sub(lambda m: " " * len(m[0]), out)
    low = out.lower()
    if len(low) != len(out):
        low = "".join(c.lower()[:1] for c in out)
    low = _DIGIT.sub("0", low)
    return _ID.sub(lambda m: "0" * len(m[0]), low) if "0" in low else low


def segments(text: str) -> list[str]:
    """Sentences, lines and cells of a folded text without the marks at their ends."""
    return [x for s in _SEGMENT.split(text) if s and (x := s.strip().rstrip(" .!?…,"))]


# ------------------------------------------------------------------------------------------- the models

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD], np.uint64)
_MARK = 2  # code of the padding
_ALPHA = np.array([chr(c).isalpha() for c in range(0x3000)])
_OPENING = np.array([chr(c) in "“„«‘" for c in range(0x3000)])


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the texts with padding around each; where each begins, and its length."""
    pad = chr(_MARK) * PAD
    codes = np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    return codes, PAD + np.cumsum(size + PAD) - size - PAD, size


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """For each order the hash of the n-gram that ends at each place: a sum of products, so that the context
    of an n-gram is its hash without the last product."""
    c = codes.astype(np.uint64) + np.uint64(1)
    h = c * _FACTORS[0]
    out = [h]
    for i in range(1, ORDERS[-1]):
        h = h.copy()
        h[i:] += c[:-i] * _FACTORS[i]
        if i + 1 in ORDERS:
            out.append(h)
    return out


def _bins(h: np.ndarray, o: int) -> np.ndarray:
    return (h >> np.uint64(64 - BITS[o])).astype(np.int64)


_GRAM = ("o", "bin", "context", "shorter", "k", "n")


def _counted(k: int, texts: list[str]) -> dict[str, np.ndarray]:
    """The n-grams of texts of a class by bin: order, bin, hash of the context, bin of the n-gram shorter by
    an order, class and count."""
    codes, _, _ = _joined(texts)
    own = np.flatnonzero(codes != _MARK)
    hs = _hashes(codes)
    cols: dict[str, list] = {c: [] for c in _GRAM}
    for o in range(len(ORDERS)):
        b = _bins(hs[o][own], o)
        if len(b) < 1 << BITS[o] >> 2:
            at, one, n = np.unique(b, return_index=True, return_counts=True)
            one = own[one]  # an example of each
        else:
            n = np.bincount(b, minlength=1 << BITS[o])
            at = np.flatnonzero(n)
            n = n[at]
            one = np.zeros(1 << BITS[o], np.int64)
            one[b] = own
            one = one[at]
        cols["o"].append(np.full(len(at), o, np.int32))
        cols["bin"].append(at.astype(np.int32))
        cols["context"].append(_context(hs[o][one], hs[0][one]).astype(np.int32))
        cols["shorter"].append((_bins(hs[o - 1][one], o - 1) if o else np.zeros(len(at))).astype(np.int32))
        cols["k"].append(np.full(len(at), k, np.int32))
        cols["n"].append(n.astype(np.int64))
    return {c: np.concatenate(x) for c, x in cols.items()}


class Models:
    """Log probabilities of a character after those before it, of every class, for each n-gram seen: each
    order is interpolated with the shorter one by how often a class saw the context.  An n-gram no class has seen
    takes the value of the shorter one, for all classes alike and unscaled.  Single characters are no evidence: all
    classes share their frequencies."""

    def __init__(self, tables: list[np.ndarray], checks: list[np.ndarray]) -> None:
        self.tables = tables  # four half floats as one number, 0 where no class has the n-gram
        self.checks = checks  # bits of the context, which tell the n-gram from others of its bin

    @classmethod
    def of(cls, o: np.ndarray, bins: np.ndarray, context: np.ndarray, shorter: np.ndarray, n: np.ndarray) -> Models:
        """n: [classes, rows]."""
        tables, checks, lower = [], [], np.zeros((1, 4))
        for i, bits in enumerate(BITS):
            mine = np.flatnonzero(o == i)
            at, few = bins[mine], n[:, mine].astype(np.float64)
            if i == 0:
                p = np.repeat(((few.sum(0) + 0.5) / (few.sum() + 500))[None], 4, axis=0)
            else:
                kept = few.copy()
                if ORDERS[i] > 2:  # once most bins are taken, what falls into a bin by chance counts as unseen too
                    load = np.zeros(1 << bits)
                    load[at] = few[NATURAL]
                    kept[NATURAL] = np.maximum(few[NATURAL] - DISCOUNT - np.median(load), 0)
                _, of = np.unique(context[mine], return_inverse=True)
                p = np.empty_like(few)
                for k in range(4):  # what is discounted goes to the shorter context
                    seen, held = np.bincount(of, few[k])[of], np.bincount(of, kept[k])[of]
                    p[k] = (kept[k] + (seen - held + TRUST[k]) * lower[shorter[mine], k]) / (seen + TRUST[k])
            lower = np.zeros((1 << bits, 4))
            lower[at] = p.T
            table = np.zeros((1 << bits, 4), np.float16)
            table[at] = np.log(np.clip(p.T, LEAST_P, 0.999))
            tables.append(table.view(np.uint64).ravel())
            checks.append(np.zeros(1 << bits, np.uint16))
            checks[-1][at] = context[mine] & 0xFFFF
        return cls(tables, checks)

    def packed(self) -> list[tuple[np.ndarray, ...]]:
        """The places taken: a broadcast of these is as small as what was learned."""
        return [((i := np.flatnonzero(t)).astype(np.int32), t[i], c[i]) for t, c in zip(self.tables, self.checks, strict=True)]

    @classmethod
    def unpacked(cls, packed: list[tuple[np.ndarray, ...]]) -> Models:
        tables, checks = ([np.zeros(1 << bits, kind) for bits in BITS] for kind in (np.uint64, np.uint16))
        for t, c, (i, values, own) in zip(tables, checks, packed, strict=True):
            t[i] = values
            c[i] = own
        return cls(tables, checks)

    def log_probs(self, codes: np.ndarray, orders: int = len(ORDERS), hs: list[np.ndarray] | None = None) -> np.ndarray:
        """[classes, characters]: of the longest n-gram, among the first orders, that any class has; 0 in the padding."""
        hs = hs or _hashes(codes)
        out = self._found(orders - 1, hs[orders - 1], hs[0])
        for o in range(orders - 2, -1, -1):
            open_ = np.flatnonzero(out == 0)
            out[open_] = self._found(o, hs[o][open_], hs[0][open_])
        out[codes == _MARK] = 0
        return np.ascontiguousarray(out.view(np.float16).reshape(-1, 4).T).astype(np.float32)


    def _found(self, o: int, h: np.ndarray, last: np.ndarray) -> np.ndarray:
        at = _bins(h, o)
        out = self.tables[o][at]
        out *= self.checks[o][at] == _context(h, last).astype(np.uint16)
        return out


def _context(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash, of 31 bits, of an n-gram without its last character."""
    return (h - last) >> np.uint64(33)


# ---------------------------------------------------------------------------------- labels of segments


def _seed_bins(seeds: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(1 << BITS[-1], bool)
    codes, _, _ = _joined([s for x in seeds for s in segments(folded(x))])
    out[_bins(_hashes(codes)[-1], len(ORDERS) - 1)[_inside(codes)]] = True
    return out


def _inside(codes: np.ndarray) -> np.ndarray:
    """Where a whole n-gram of the longest order ends."""
    own = (codes != _MARK).astype(np.int32)
    run = np.cumsum(own)
    out = np.zeros(len(codes), bool)
    out[6:] = run[6:] - run[:-6] == 6
    return out


_NOTICE_BINS = _seed_bins(NOTICE_SEEDS)
FILL_WORDS = frozenset(w for x in (*LATIN_SEEDS, *FILLER_SEEDS) for w in _WORD.findall(x) if len(w) > 3)


def _names(n: int = 60, seed: int = 5) -> list[str]:
    """Names of slots made of letters drawn alike, so that the marks tell a slot and not the words in it."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyzäéñабвгдежзиклмнопрстуя"
    word = lambda: "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(2, 9)))
    return [str(rng.integers(10)) if i % 12 == 0 else "_ "[i % 2].join(word() for _ in range(rng.integers(1, 4))) for i in range(n)]


NAMED = tuple([" ".join(f % n for n in _names()) for f in SLOT_FORMS] + [f % n for f in SLOT_FORMS for n in _names(6)] + [" ".join(f"{w} {b}{m} {w}" for w in "aeionrst" for m in (",", ":", "", ".", "!")) for b in BARE_SLOTS])
SEEDS = {FILLER: (*LATIN_SEEDS, *FILLER_SEEDS), NOTICE: NOTICE_SEEDS, SLOT: NAMED}


def near_notices(parts: list[str]) -> np.ndarray:
    """Share of the n-grams of each segment that stand in seeds of notices; 0 for shorter segments."""
    if not parts:
        return np.zeros(0)
    codes, start, size = _joined(parts)
    full = _inside(codes)
    hit = np.r_[0, np.cumsum(full & _NOTICE_BINS[_bins(_hashes(codes)[-1], len(ORDERS) - 1)])]
    return (hit[start + size] - hit[start]) / np.maximum(1, size - 5)


def _fills(s: str) -> bool:
    """Words of the seeds of filler, or words said over and over."""
    words = _WORD.findall(s)
    if len(words) < 2:
        return False
    size = sum(map(len, words))
    return sum(len(w) for w in words if w in FILL_WORDS) >= 0.6 * size or len(words) >= 4 and size >= 12 and len(set(words)) * 2 <= len(words)


def company(docs: list[list[str]]) -> Iterator[tuple[str, int, float, int]]:
    """(segment, 1 where it stands with others, share of the others' characters near the seeds of notices, bits
    of the hashes of the others) of each text."""
    docs = [list(dict.fromkeys(d)) for d in docs if d]
    parts = [s for d in docs for s in d]
    if not parts:
        return
    count = np.fromiter(map(len, docs), np.int64, len(docs))
    first = np.cumsum(count) - count
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    size[size < COMPANION] = 0
    told = size * (near_notices(parts) >= NEAR)
    bit = np.uint64(1) << np.fromiter((zlib.crc32(s.encode("utf-8", "surrogatepass")) & 63 for s in parts), np.uint64, len(parts))
    bit[size == 0] = 0
    others = np.repeat(np.add.reduceat(size, first), count) - size
    near = np.repeat(np.add.reduceat(told, first), count) - told
    bits = np.repeat(np.bitwise_or.reduceat(bit, first), count) & ~bit
    yield from zip(parts, (others > 0).astype(np.int64).tolist(), (near / np.maximum(others, 1)).tolist(), bits.tolist(), strict=True)


def first_labels(parts: list[str], others: np.ndarray, told: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Classes of distinct segments by the seeds and their company; -1 where it isn't clear yet.  others: texts in
    which a segment has company; told: sum of the shares of that company near the seeds of notices; kinds: number
    of different companions, up to 64."""
    near = near_notices(parts)
    share = told / np.maximum(others, 1)
    label = np.where((others > 0) & (share < ANCHORED / 2) & (near < FAR), NATURAL, -1)
    label[(near >= NEAR) & (share >= ANCHORED / 2)] = NOTICE
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    label[(others == 0) & (near >= ALONE) & (size >= COMPANION)] = NOTICE
    label[(others > 0) & (share >= ANCHORED)] = NOTICE
    label[_vouched(others, told, kinds)] = NATURAL
    label[[i for i, s in enumerate(parts) if _fills(s)]] = FILLER
    return label


def next_labels(models: Models, parts: list[str], others: np.ndarray, told: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Classes of segments by the models, and the segments without the slots found in them."""
    codes, start, size = _joined(parts)
    hs = _hashes(codes)
    lp = models.log_probs(codes, hs=hs)
    total = np.concatenate([np.zeros((4, 1)), np.cumsum(lp, axis=1, dtype=np.float64)], axis=1)
    score = (total[:, start + size] - total[:, start])[:3]
    share = told / np.maximum(others, 1)
    score[NATURAL] += PRIOR * (share < ANCHORED)
    best = score.argmax(0)
    score.sort(axis=0)
    sure = np.where((best == NATURAL) | (others > 0), SURE, SURE_ALONE)
    label = np.where(score[2] - score[1] > sure * size, best, -1)
    label[(others > 0) & (share >= ANCHORED) & (label != FILLER)] = NOTICE
    label[_vouched(others, told, kinds) & (label != FILLER)] = NATURAL  # such as a review that mentions one
    rest = list(parts)
    for i, a, b in zip(*_slot_windows(models.log_probs(codes, 2, hs), start, size, MAYBE_SLOT_NATS), strict=True):
        own = parts[i][a:b].strip()
        if not own.isalpha() or len(set(own)) == 1 < len(own):  # else rare letters would soon be unknown to prose
            rest[i] = rest[i][:a] + chr(_MARK) * (b - a) + rest[i][b:]
    return label, rest


def _vouched(others: np.ndarray, told: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Segments that stand in several reviews, none of their company near a notice."""
    return (kinds >= VOUCHED) & (told < 0.02 * others)


def _by_class(label: np.ndarray, parts: list[str], sure: np.ndarray) -> dict[int, list[str]]:
    """The segments each class learns from; natural ones that are vouched for outweigh the discount."""
    ended = [s + ENDS[zlib.crc32(s.encode("utf-8", "surrogatepass")) % len(ENDS)] for s in parts]
    out = {k: [ended[i] for i in np.flatnonzero(label == k)] for k in (NATURAL, FILLER, NOTICE)}
    out[NATURAL] += [ended[i] for i in np.flatnonzero((label == NATURAL) & sure)] * DISCOUNT
    return out


def _summed(cols: list[dict[str, np.ndarray]]) -> Models:
    """Models of counted n-grams in memory."""
    x = {c: np.concatenate([y[c] for y in cols]) for c in _GRAM}
    key = x["o"].astype(np.int64) << 32 | x["bin"]
    order = np.lexsort((-x["n"], key))  # what is most frequent in a bin stands for it
    x = {c: v[order] for c, v in x.items()}
    keys, first, of = np.unique(key[order], return_index=True, return_inverse=True)
    n = np.stack([np.bincount(of, x["n"] * (x["k"] == k), minlength=len(keys)) for k in range(4)])
    return Models.of(*(x[c][first] for c in ("o", "bin", "context", "shorter")), n)


def _seed_counts() -> list[dict[str, np.ndarray]]:
    return [_counted(k, [p for s in x for p in (segments(folded(s)) if k != SLOT else [s])]) for k, x in SEEDS.items()]


def fit(texts: list[str]) -> Models:
    """Models from the seeds and texts in memory; what fitted() does for a table."""
    known: dict[str, list] = {}
    for s, c, t, bits in company([segments(folded(x)) for x in texts]):
        got = known.setdefault(s, [0, 0.0, 0])
        got[0] += c
        got[1] += t
        got[2] |= bits
    parts = list(known)
    others, told = (np.array([x[i] for x in known.values()], np.float64) for i in (0, 1))
    kinds = np.array([x[2].bit_count() for x in known.values()], np.int64)
    label, rest = first_labels(parts, others, told, kinds), parts
    for turn in range(ROUNDS + 1):
        models = _summed([*_seed_counts(), *(_counted(k, x) for k, x in _by_class(label, rest, _vouched(others, told, kinds)).items() if x)])
        if turn < ROUNDS and parts:
            label, rest = next_labels(models, parts, others, told, kinds)
    return models


def fitted(documents: DataFrame) -> Models:
    """Models from the seeds and all texts of a table."""
    spark: SparkSession = documents.sparkSession
    ship(spark)

    def read(batches):
        held: dict[str, list] = {}

        def flush():
            out = {"s": list(held)} | {k: [x[i] for x in held.values()] for i, k in enumerate("ct")} | {"b": [x[2] - (1 << 64 if x[2] >> 63 else 0) for x in held.values()]}
            held.clear()
            return out

        for b in batches:
            texts = b.column(0).to_pylist()
            for part in portions(texts, PORTION):
                for s, c, t, bits in company([segments(folded(x)) for x in texts[part]]):
                    got = held.setdefault(s, [0, 0.0, 0])
                    got[0] += c
                    got[1] += t
                    got[2] |= bits
                if len(held) > MOST_HELD:
                    yield flush()
        yield flush()

    counted = arrow_stream(documents.where("text is not null").select("text"), read, "s string, c bigint, t double, b bigint")
    types = cut(counted.groupBy("s").agg(F.sum("c").alias("c"), F.sum("t").alias("t"), F.bit_count(F.bit_or("b")).alias("kinds")), "segments")
    models: Models | None = None
    for _ in range(ROUNDS + 1):
        shared = spark.sparkContext.broadcast(models.packed() if models else None)
        grams = arrow_stream(types, _learning(shared), "o int, bin int, context int, shorter int, k int, n bigint")
        grams = grams.unionByName(spark.createDataFrame(pa.table(_merged(_seed_counts()))))
        sums = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
        whole = grams.groupBy("o", "bin").agg(F.max(F.struct("n", "context", "shorter")).alias("of"), *sums)
        # at most one row for each bin of the tables
        t = whole.select("o", "bin", "of.context", "of.shorter", *[f"n{k}" for k in range(4)]).toArrow()
        cols = [t.column(i).to_numpy() for i in range(8)]
        models = Models.of(*cols[:4], np.stack(cols[4:]))
        shared.destroy()
    return models


def _merged(cols: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([x[c] for x in cols]) for c in _GRAM}


def _learning(shared):
    """The n-grams of each class of a task's segments, labelled by the models or, without any, by the seeds."""

    def run(batches):
        models = Models.unpacked(shared.value) if shared.value else None
        held: dict[int, list[str]] = {NATURAL: [], FILLER: [], NOTICE: []}
        size = 0

        def flush():
            for k, texts in held.items():
                if texts:
                    yield _counted(k, texts)
                    texts.clear()

        for b in batches:
            parts, cols = b.column(0).to_pylist(), [b.column(i).to_numpy() for i in (1, 2, 3)]
            for part in portions(parts, PORTION):
                x = (parts[part], *(c[part] for c in cols))
                label, rest = next_labels(models, *x) if models else (first_labels(*x), x[0])
                for k, texts in _by_class(label, rest, _vouched(*x[1:])).items():
                    held[k] += texts
                    size += sum(map(len, texts))
                if size >= COUNTED:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


# --------------------------------------------------------------------------------------------- judging


def judge(models: Models, texts: list[str | None]) -> list[dict]:
    """For each text the share of letters filler and notices cover, the longest run of filler, the slots
    found, and whether it is a case."""
    out = [{"filler_run": 0, "filler_coverage": 0.0, "notice_coverage": 0.0, "slots": [], "case": False} for _ in texts]
    clean = [folded(t) if t else "" for t in texts]
    full = [i for i, t in enumerate(clean) if t and not t.isspace()]
    if not full:
        return out
    codes, start, size = _joined([clean[i] for i in full])
    hs = _hashes(codes)
    lp = models.log_probs(codes, hs=hs)
    end = start + size
    # what a review quotes says nothing for filler and notices
    for j in np.unique(np.searchsorted(start, np.flatnonzero(_OPENING[np.minimum(codes, 0x2FFF)]), "right") - 1).tolist():
        for m in _QUOTED.finditer(clean[full[j]]):
            if m[0][0] not in "\"`":
                a, b = start[j] + m.start(), start[j] + m.end()
                lp[FILLER, a:b] = lp[NOTICE, a:b] = lp[NATURAL, a:b]
    visible = _ALPHA[np.minimum(codes, 0x2FFF)]
    sums = np.cumsum(lp, axis=1, dtype=np.float64)
    sums = np.concatenate([sums[:, WINDOW - 1 : WINDOW], sums[:, WINDOW:] - sums[:, :-WINDOW]], axis=1)
    filler = _windows(lp, sums, FILLER, (NATURAL, NOTICE))
    notice = _windows(lp, sums, NOTICE, (NATURAL, FILLER))
    spans = {k: [] for k in range(len(full))}
    for i, a, b in zip(*_slot_windows(models.log_probs(codes, 2, hs), start, size), strict=True):
        spans[i].append((a, b))
    # mentions in quotes are no filler
    for j in np.unique(np.searchsorted(start, np.flatnonzero(filler), "right") - 1).tolist():
        for m in _QUOTED.finditer(clean[full[j]]):
            filler[start[j] + m.start() : start[j] + m.end()] = False
    count = lambda x: (lambda s: s[end] - s[start])(np.r_[0, np.cumsum(x)])
    letters = np.maximum(1, count(visible))
    covered, told, any_notice = count(filler & visible) / letters, count((notice | filler) & visible) / letters, count(notice)
    run = np.zeros(len(full), np.int64)
    edges = np.flatnonzero(np.diff(np.r_[False, filler, False].astype(np.int8)))
    np.maximum.at(run, np.searchsorted(start, edges[::2], "right") - 1, edges[1::2] - edges[::2])
    for j, i in enumerate(full):
        r = out[i]
        r["filler_run"], r["filler_coverage"] = int(run[j]), float(covered[j])
        r["notice_coverage"] = float(told[j]) if any_notice[j] else 0.0
        if spans[j]:
            r["slots"] = confirmed(canonical(texts[i]), spans[j])
        r["case"] = bool(r["slots"]) or r["filler_run"] >= FILLER_RUN or r["filler_coverage"] >= NOTICE_COVERAGE and r["filler_run"] >= LEAST_RUN or r["notice_coverage"] >= NOTICE_COVERAGE
    return out


def confirmed(text: str, spans: list[tuple[int, int]]) -> list[str]:
    """Of the windows found, the placeholders that have the form of one and aren't part of a longer quotation."""
    quotes = [m.span() for m in _QUOTED.finditer(text)]
    out = []
    for m in _SLOT.finditer(text):
        if any(a < m.end() and m.start() < b for a, b in spans) and not any(a <= m.start() and m.end() <= b and b - a > m.end() - m.start() for a, b in quotes):
            out.append(m.group())
    return out


def _slot_windows(lp: np.ndarray, start: np.ndarray, size: np.ndarray, nats: float = SLOT_NATS) -> tuple[list[int], list[int], list[int]]:
    """(text, from, to) of the windows of any width whose likelihood as a slot beats natural prose by `nats`:
    the ratio is summed from where it was lowest before.  lp is of the shortest contexts: longer ones tell names
    and greetings, which stand in any text, from others."""
    ratio = lp[SLOT] - lp[NATURAL]
    away = np.zeros(len(ratio))
    away[start - 1] = -1e6  # sums begin anew in each text
    total = np.cumsum(ratio.astype(np.float64) + away)
    low = np.minimum.accumulate(total)
    hit = total - low > nats
    hit &= lp[SLOT] != 0
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    a, b = edges[::2], edges[1::2]
    # a window begins behind the lowest sum
    at = np.flatnonzero(np.r_[True, np.diff(low) < 0])
    begin = at[np.searchsorted(at, a, "right") - 1] + 1
    text = np.searchsorted(start, a, "right") - 1
    begin = np.maximum(begin, start[text])
    return text.tolist(), (begin - start[text]).tolist(), (np.minimum(b, start[text] + size[text]) - start[text]).tolist()


def _windows(lp: np.ndarray, sums: np.ndarray, k: int, others: tuple[int, ...]) -> np.ndarray:
    """Characters that lie in a window whose likelihood under class k beats every other class by MARGIN nats
    a character, from its first to its last character in favour.  The padding lets texts shorter than a window
    count with all they have."""
    n = lp.shape[1]
    hit = sums[k] - sums[list(others)].max(0) > MARGIN[k] * WINDOW
    out = np.zeros(n, bool)
    if hit.any():
        edge = np.zeros(n + 1, np.int32)
        edge[: len(hit)] += hit
        edge[WINDOW : WINDOW + len(hit)] -= hit
        runs = np.flatnonzero(np.diff(np.r_[False, np.cumsum(edge[:-1]) > 0, False].astype(np.int8)))
        good = np.flatnonzero(lp[k] > lp[list(others)].max(0))
        first, last = np.searchsorted(good, runs[::2]), np.searchsorted(good, runs[1::2]) - 1
        ok = first <= last
        mark = np.zeros(n + 1, np.int32)
        np.add.at(mark, good[first[ok]], 1)
        np.add.at(mark, good[last[ok]] + 1, -1)
        out = np.cumsum(mark[:-1]) > 0
    return out


def judged(documents: DataFrame, models: Models | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, is_case, filler_run, filler_coverage, notice_coverage, slots) of each document, and the columns of
    `keep`, which pass through: nothing is joined back."""
    spark: SparkSession = documents.sparkSession
    ship(spark)
    models = models or fitted(documents)
    shared = spark.sparkContext.broadcast(models.packed())
    held: list[Models] = []

    def run(batch):
        held or held.append(Models.unpacked(shared.value))
        m = held[0]
        texts = batch.column(1).to_pylist()
        got = [g for part in portions(texts, PORTION) for g in judge(m, texts[part])]
        return {
            "doc_id": batch.column(0).to_pylist(),
            "is_case": [g["case"] for g in got],
            "filler_run": [g["filler_run"] for g in got],
            "filler_coverage": [g["filler_coverage"] for g in got],
            "notice_coverage": [g["notice_coverage"] for g in got],
            "slots": [g["slots"] for g in got],
        } | {f"kept_{i}": batch.column(2 + i).to_pylist() for i in range(len(keep))}

    src = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)])
    types = "".join(f", kept_{i} {documents.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = arrow_map(src, run, "doc_id bigint, is_case boolean, filler_run int, filler_coverage double, notice_coverage double, slots array<string>" + types)
    return out.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})
