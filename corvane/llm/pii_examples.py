"""Made-up examples of personal data and of what only looks like it, from a seed: what the trees of ``pii`` learn from.

An example is a text with one span, and the kind that the span is, or none. Look-alikes take the forms that
web text and code are full of: links, paths and file names, tags with their attributes, style sheets,
assignments and calls, identifiers in every case, hashes, numbers of all sorts. Words are made of syllables,
so that no list of words has to be learned by heart.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

Example = tuple[str, int, int, str | None]  # text, span, its kind

_ONSETS, _VOWELS, _CODAS = "b c d f g h j k l m n p r s t v w z br ch cl cr dr fl gr pl pr qu sh sp st th tr".split(), "a e i o u ai ea ee ou".split(), " n r s t l m nd nt st rt ng ck".split(" ")
_DIGITS, _HEX, _LOWER = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = _LOWER + _LOWER.upper() + _DIGITS
# Names as they stand in pages and code.
_DOMAINS = "com org net de fr es io info co.uk edu".split()
_EXTENSIONS = "html js css png jpg svg php json xml pdf woff2 min.js ts py java md txt gif webp aspx".split()
_LINK_ATTRIBUTES = "href src action data-src srcset poster cite content data-url xlink:href formaction".split()
_ATTRIBUTES = "class id style rel type name title alt lang target role data-id property aria-label media onclick placeholder for".split()
_STYLES = "color background font-family margin padding display text-align border transition width z-index".split()
_SECRET_NAMES = "password passwd pwd secret token api_key apikey api-key access_token auth_token client_secret private_key secret_key credentials bearer session_token DB_PASSWORD AWS_SECRET_ACCESS_KEY API_TOKEN".split()


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def chars(self, n: int, of: str) -> str:
        return "".join(self.r.choice(of) for _ in range(n))

    def digits(self, n: int) -> str:
        return self.chars(n, _DIGITS)

    def word(self, most: int = 3) -> str:
        return "".join(self.r.choice(_ONSETS) + self.r.choice(_VOWELS) + self.r.choice(_CODAS) for _ in range(self.r.randint(1, most)))

    def words(self, low: int, high: int, by: str = " ") -> str:
        return by.join(self.word() for _ in range(self.r.randint(low, high)))

    def prose(self) -> str:
        return self.words(1, 6) + self.r.choice((" ", " ", ": ", ", ", ". "))

    def pick(self, *makers):
        found = self.r.choice(makers)
        return found() if callable(found) else found

    def random_text(self) -> str:
        """What a machine made to be guessed by no one."""
        r = self.r
        return self.pick(
            lambda: self.chars(r.randint(12, 64), _ALNUM), lambda: self.chars(r.choice((16, 18, 20, 24, 32, 40, 64)), _HEX), lambda: self.chars(r.choice((32, 40, 44)), _ALNUM + "+/"), lambda: self.chars(r.randint(8, 16), _ALNUM + "!#%$@^*"),
            lambda: self.chars(r.randint(16, 43), _ALNUM + "-_"), lambda: self.chars(r.randint(60, 900), _ALNUM),
        )

    def key(self) -> str:
        """A key whose beginning names its service."""
        return self.pick(
            lambda: self.r.choice(("AKIA", "ASIA")) + self.chars(16, _LOWER.upper() + "234567"), lambda: self.r.choice(("ghp_", "gho_", "glpat-")) + self.chars(36, _ALNUM), lambda: self.r.choice(("sk_live_", "sk_test_", "sk-")) + self.chars(24, _ALNUM),
            lambda: "xoxb-" + self.digits(11) + "-" + self.chars(24, _ALNUM), lambda: "AIza" + self.chars(35, _ALNUM + "_-"), lambda: f"eyJ{self.chars(20, _ALNUM)}.eyJ{self.chars(self.r.randint(30, 120), _ALNUM)}.{self.chars(43, _ALNUM + '_-')}",
        )

    def host(self) -> str:
        return self.r.choice(("", "www.", "cdn.", "api.", self.word(1) + ".")) + self.word() + self.r.choice(("", "-" + self.word(1))) + "." + self.r.choice(_DOMAINS)

    def path(self) -> str:
        parts = [self.pick(self.word, lambda: self.words(2, 6, "-"), lambda: self.digits(self.r.randint(1, 8)), lambda: self.words(2, 3, "_"), lambda: self.r.choice(("static", "assets", "img", "js", "wp-content", "en", "node_modules", "index"))) for _ in range(self.r.randint(1, 5))]
        return "/".join(parts) + self.pick("", "/", lambda: "." + self.r.choice(_EXTENSIONS), lambda: f"-{self.chars(8, _HEX)}.{self.r.choice(_EXTENSIONS)}", lambda: f".{self.r.choice(_EXTENSIONS)}?v={self.digits(self.r.randint(1, 10))}")

    def link(self) -> str:
        return self.pick(
            lambda: f"{self.r.choice(('http://', 'https://', 'https://', '//', 'ftp://'))}{self.host()}/{self.path()}", lambda: f"https://{self.host()}/{self.path()}?{self.word(1)}={self.word()}&{self.word(1)}={self.digits(4)}", lambda: "/" + self.path(),
            lambda: "../" + self.path(), lambda: "./" + self.path(), self.path, lambda: "#" + self.words(1, 4, "-"), lambda: f"https://{self.host()}", lambda: f"mailto:{self.word()}", lambda: f"{self.word()}.{self.r.choice(_EXTENSIONS)}", lambda: f"C:\\{self.words(2, 4, chr(92))}.{self.r.choice(_EXTENSIONS)}",
        )

    def identifier(self) -> str:
        return self.pick(
            lambda: self.words(2, 5, "_"), lambda: self.words(2, 5, "-"), lambda: self.words(2, 4, ".").lower(), lambda: self.word() + "".join(self.word().title() for _ in range(self.r.randint(1, 4))), lambda: "".join(self.word().title() for _ in range(self.r.randint(2, 4))), lambda: self.words(2, 4, "_").upper(),
            lambda: self.words(3, 6, "/"), lambda: self.words(1, 3, "_") + "_" + self.digits(self.r.randint(1, 6)), lambda: self.words(2, 4, "") + self.r.choice(("", "s")), lambda: f"{self.words(1, 3, '-')}-{self.digits(3)}x{self.digits(3)}",
        )

    def code(self) -> str:
        i, d = self.identifier, lambda: self.digits(self.r.randint(1, 3))
        return self.pick(
            lambda: f"{i()}({self.word()})", lambda: f"{i()}({self.word()},{d()})", lambda: f"new {i()}()", lambda: f"np.{self.word()}([{d()},{d()}])", lambda: f"{self.word()}[{d()}].{self.word()}", lambda: f"function({self.word(1)}){{{self.word()}", lambda: f"{self.word()}.{self.word()}({self.word()}.{self.word()})",
            lambda: f"lambda {self.word(1)}:{self.word()}", lambda: f"{d()}}}</style><script>{self.word()}", lambda: f"({self.word()}||{self.word()}).{self.word()}", lambda: f"{d()}px}}.{self.words(1, 3, '-')}{{{self.word()}", lambda: f"&{self.word()}={d()}", lambda: f"{self.word()}+{self.word()}*{d()}", lambda: f"<{self.word(1)}>{self.word()}</{self.word(1)}>",
            lambda: f"${{{i()}}}", lambda: f"{{{{{i()}}}}}", lambda: f"os.environ[{self.word()}]", lambda: f"$({self.word()}).{self.word()}()", lambda: f"rgba({d()},{d()},{d()},0.{self.digits(1)})", lambda: f"translate({d()}px,{d()}px)", lambda: f"{self.word()}::{self.word()}<{self.word()}>",
        )

    def harmless_value(self) -> str:
        """What stands after = or : and in attributes, and is no secret."""
        d = self.digits
        return self.pick(
            self.link, self.link, self.link, self.identifier, self.identifier, self.code, self.code, lambda: self.words(2, 4, "+"), lambda: f"20{d(2)}-{self.r.randint(1, 12):02d}-{self.r.randint(1, 28):02d}T{d(2)}:{d(2)}:{d(2)}Z", lambda: d(self.r.randint(8, 19)), lambda: f"{d(2)}.{d(6)}", lambda: "#" + self.chars(8, _HEX),
            lambda: f"application/{self.word()}", lambda: f"text/{self.word()}", lambda: f"{self.word()}.{self.word()}.{self.word()}", lambda: f"v{d(1)}.{d(2)}.{d(1)}-{self.word()}", lambda: f"{self.word().title()}%20{self.word()}", lambda: self.words(2, 3, "").title(), lambda: f"{self.word()}@{self.word()}", lambda: f"UA-{d(8)}-{d(1)}",
            lambda: f"{d(3)}px", lambda: f"width={d(3)}", lambda: f"{self.words(2, 4, '')}", lambda: f"{self.word()}é{self.word()}", lambda: f"sha256-{self.chars(43, _ALNUM)}=", lambda: f"{self.chars(8, _HEX)}-{self.chars(4, _HEX)}-4{self.chars(3, _HEX)}-a{self.chars(3, _HEX)}-{self.chars(12, _HEX)}",
        )

    def harmless(self) -> tuple[str, str, str]:
        """before, span, after of a value that is no secret."""
        attribute, value, name = self.r.choice, self.harmless_value, self.identifier
        return self.pick(
            lambda: (f'<{attribute(("a", "img", "script", "link", "form", "iframe"))} {attribute(_LINK_ATTRIBUTES)}="', self.link(), '">'), lambda: (f"<a {attribute(_LINK_ATTRIBUTES)}=", self.link(), ">"), lambda: (f'<div {attribute(_ATTRIBUTES)}="', value(), '">'), lambda: (f"<{self.word(1)} {attribute(_ATTRIBUTES)}=", value(), ">"),
            lambda: (f"{name()} = ", value(), "\n"), lambda: (f"{name()}=", value(), " "), lambda: (f'"{name()}": "', value(), '",'), lambda: (f"{name()}: ", value(), "\n"), lambda: (f"{attribute(_STYLES)}:", value(), ";"), lambda: ("see ", self.link(), " for"), lambda: (f"{self.prose()}", self.link(), " "),
            lambda: (f"var {self.word()}=", self.code(), ";"), lambda: (f"let {self.word()} = ", self.code(), ""), lambda: ("url: ", self.link(), ""), lambda: ("commit ", self.chars(40, _HEX), "\n"), lambda: ("sha256:", self.chars(64, _HEX), ""), lambda: (f'integrity="sha384-', self.chars(64, _ALNUM + "+/"), '"'),
            lambda: (f"data:image/{attribute(('png', 'jpeg', 'svg+xml'))};base64,", attribute(("iVBORw0KGgo", "/9j/4AAQ", "PHN2Zy")) + self.chars(self.r.randint(20, 300), _ALNUM + "+/"), '"'), lambda: (self.prose(), self.identifier(), " "), lambda: (f"import {self.word()} from ", self.words(2, 4, "/"), ""), lambda: ("id=", self.digits(self.r.randint(8, 20)), ""),
            lambda: (self.prose(), self.chars(attribute((32, 40, 64)), _HEX), attribute((" ", ".", "\n"))), lambda: (f'{name()}: "', self.chars(attribute((32, 40, 64)), _HEX), '"'), lambda: (f"{self.words(1, 2)} ", self.chars(40, _HEX), ""), lambda: (f'{self.word()}: {self.word(1)}"', self.chars(32, _HEX), '"'),
            lambda: (f"the {attribute(_SECRET_NAMES[:6])} ", self.words(2, 3, "-"), " was"), lambda: (f"{attribute(('password', 'token', 'secret', 'api_key'))}: ", attribute(("required", "string", "forgotten?", "optional")) + self.word(1), "\n"), lambda: (f"{attribute(('password', 'token', 'secret', 'api_key'))}=", f"{attribute(('os.environ', 'get', 'input', 'config', 'request'))}{attribute(('[', '(', '.'))}{self.word()}", "\n"),
            lambda: (f'<input type="password" {attribute(("name", "id", "placeholder"))}="', self.identifier(), '">'), lambda: ("md5 ", self.chars(32, _HEX), " of"), lambda: ("checksum ", self.chars(40, _HEX), " "), lambda: ("merged in ", self.chars(40, _HEX), " by"), lambda: ("uuid ", f"{self.chars(8, _HEX)}-{self.chars(4, _HEX)}-{self.chars(4, _HEX)}-{self.chars(4, _HEX)}-{self.chars(12, _HEX)}", " "),
        )

    def secret(self) -> tuple[str, str, str]:
        name, quote = self.r.choice(_SECRET_NAMES), self.r.choice(("", "", '"', "'"))
        return self.pick(
            lambda: (self.r.choice(("my key ", "the token ", "key ", "secret ", "API key: ", "token: ", "credentials ")), self.chars(self.pick(40, 64, lambda: self.r.randint(24, 60), lambda: self.r.randint(60, 900)), self.r.choice((_ALNUM, _ALNUM, _HEX))), self.r.choice((" ", ",", "\n"))),
            lambda: (self.r.choice(("key ", "aws ", self.prose(), self.prose(), "key=", '"', "to ")), self.key(), self.r.choice((" ", '"', ", ", "\n"))),
            lambda: (f"{name}{self.r.choice(('=', ' = ', ': ', ':'))}{quote}", self.random_text(), quote or self.r.choice((" ", "\n"))), lambda: (f"{name.upper()}={quote}", self.random_text(), quote or "\n"), lambda: (f'"{name}": "', self.random_text(), '",'), lambda: (f'token = "', self.chars(40, _HEX), '" '),
            lambda: (f"https://{self.word()}:", self.pick(self.key, lambda: self.chars(self.r.randint(16, 40), _ALNUM)), f"@{self.host()}/{self.path()} "),
            lambda: ("Authorization: Bearer ", self.pick(self.key, self.random_text), "\n"), lambda: (f"X-{self.r.choice(('Api-Key', 'Auth-Token', 'Secret'))}: ", self.random_text(), "'"), lambda: (f'<input type="hidden" name="{name}" value="', self.chars(self.r.randint(20, 64), _ALNUM), '">'),
            lambda: (f"{self.r.choice(('my', 'the', 'your', 'new'))} {self.r.choice(('password', 'secret', 'token', 'api key'))} is ", self.chars(self.r.randint(16, 40), _ALNUM), " "), lambda: (f"https://{self.host()}/{self.word()}?{self.r.choice(('access_token', 'api_key', 'token'))}=", self.chars(self.r.randint(20, 40), _ALNUM), " "),
        )

    def phone(self) -> tuple[str, str, str]:
        d, r = self.digits, self.r
        word = self.pick(*(w + r.choice((" ", ": ", ". ", "")) for w in ("tel", "Tel.", "call", "phone", "Telefon", "mobile", "fax", "cell", "telephone", "Handy", "numero", "número", "teléfono", "téléphone", "Rufnummer", "dial", "WhatsApp", "ring", "portable", "móvil", "Mobil")), self.prose)
        form = self.pick(
            lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"{d(3)} {d(3)} {d(4)}", lambda: f"0{r.randint(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"0{d(2)} {d(7)}", lambda: f"0{d(3)}/{d(r.randint(6, 8))}", lambda: f"0{d(4)} {d(6)}", lambda: f"{r.choice('6789')}{d(2)} {d(3)} {d(3)}",
            lambda: f"0{r.randint(10, 99)}-{d(4)}-{d(4)}", lambda: f"0{d(r.randint(9, 10))}", lambda: f"({'0' + d(2)}) {d(4)} {d(4)}",
        )
        if not word.lstrip().lower().startswith(("tel", "call", "phone", "mob", "fax", "cell", "handy", "num", "núm", "tél", "ruf", "dial", "what", "ring", "port", "móv")):
            form = self.pick(lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{r.randint(2, 9)}{d(2)}-{d(3)}-{d(4)}")  # without a word that says so only these
        return word if word.endswith((" ", ":", ".")) else word + " ", form, r.choice((" ", ".", ", ", "\n"))

    def number(self) -> tuple[str, str, str]:
        """before, span, after of digits that are no telephone number."""
        d, r = self.digits, self.r
        few = lambda: str(r.randint(1, 30))
        before = self.pick("order ", "page ", "version ", "price $", "date ", "ISBN ", "score ", "final ", "won ", "beat them ", "population ", "zip ", "between ", "from ", "lot ", "invoice no. ", "€ ", "item ", "at ", "coordinates ", "results: ", "sets ", self.prose, self.prose)
        form = self.pick(
            lambda: f"20{d(2)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", lambda: f"{d(2)}.{d(2)}.{r.choice(('19', '20'))}{d(2)}", lambda: f"{d(2)}/{d(2)}/20{d(2)}", lambda: " ".join(f"{r.randint(6, 25)}-{r.randint(6, 25)}" for _ in range(r.randint(2, 5))), lambda: f"{d(4)}-{d(4)}", lambda: " ".join(d(3) for _ in range(r.randint(2, 4))), lambda: f"{few()} {d(3)} {d(3)}",
            lambda: f"19{d(2)}-20{d(2)}", lambda: f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", lambda: f"978-{d(10)}", lambda: " ".join(d(r.randint(2, 4)) for _ in range(r.randint(3, 6))), lambda: f"{d(2)}-{d(2)}-{d(2)}", lambda: f"{d(4)} {d(4)} {d(4)} {d(4)}", lambda: f"{d(2)} {d(3)} {d(2)} {d(5)}", lambda: f"{d(2)}.{d(4)} {d(2)}.{d(4)}", lambda: f"{d(5)}-{d(4)}", lambda: d(r.randint(8, 12)),
            lambda: f"{few()}-{few()} {few()}-{few()} {few()}-{few()}", lambda: f"{d(3)}.{d(3)}.{d(3)}", lambda: f"20{d(2)} 20{d(2)} 20{d(2)}", lambda: f"{d(3)}-{d(4)}-{d(3)}", lambda: f"0{d(1)}.{d(2)}.{d(4)} {d(2)}-{d(2)}", lambda: f"{d(6)}-{d(6)}", lambda: f"{d(4)}/{d(4)}", lambda: f"0{d(3)} {d(3)}",
        )
        return before, form, r.choice((" ", ".", ", ", "\n", " %"))

    def iban(self, good: bool) -> str:
        country, letters, digits = self.r.choice((("DE", 0, 18), ("DE", 0, 18), ("ES", 0, 20), ("AT", 0, 16), ("FR", 0, 23), ("GB", 4, 14), ("NL", 4, 10), ("IT", 1, 22), ("PL", 0, 24), ("CH", 0, 17)))
        body = self.chars(letters, _LOWER.upper()) + self.digits(digits)
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        text = f"{country}{(check if good else (check + self.r.randint(1, 90)) % 97 + 2):02d}{body}"
        return " ".join(text[i : i + 4] for i in range(0, len(text), 4)) if self.r.random() < 0.5 else text

    def card(self, good: bool, luhn: Callable[[str], bool]) -> str:
        body = self.r.choice("3456") + self.digits(self.r.choice((13, 14, 14, 14)))
        check = next(c for c in _DIGITS if luhn(body + c))
        text = body + (check if good else self.r.choice(_DIGITS.replace(check, "")))
        return text if len(text) < 16 or self.r.random() < 0.5 else self.r.choice(" -").join(text[i : i + 4] for i in range(0, 16, 4))

    def other(self) -> str:
        """A keyword that belongs to something else."""
        d = self.digits
        return self.pick("", "", self.prose, lambda: f"tel {d(3)}-{d(4)}, ", lambda: f"order {d(6)}, ", lambda: f"iban {self.chars(8, _ALNUM)}, ", lambda: f"{self.r.choice(_SECRET_NAMES)} {self.word()}, ")


def examples(seed: int, n: int, luhn: Callable[[str], bool]) -> Iterator[Example]:
    """``n`` examples of each kind, as many look-alikes, and for secrets and numbers several times as many of these."""
    m = Maker(seed)
    d, r, hexes = m.digits, m.r, lambda k: m.chars(k, _HEX)
    after = lambda: m.pick(" ", ", ", "\n", ". ")
    plain = lambda *of: lambda: (m.pick(*of[0]), m.pick(*of[1]), after())
    makers: list[tuple[str | None, int, Callable[[], tuple[str, str, str]]]] = [
        ("secret", 3, m.secret), (None, 8, m.harmless), ("national_phone", 2, m.phone), (None, 4, m.number),
        ("ssn", 1, plain(("ssn ", "SSN: ", "ssn: ", "social security ", "social security number is ", "My SSN is ", "SSN#"), (lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{r.randint(1, 665):03d}-{d(2)}-{d(4)}", lambda: f"{r.randint(1, 665):03d} {d(2)} {d(4)}"))),
        (None, 1, plain(("order ", "isbn ", "sku ", "part ", "call ", m.prose), (lambda: f"{d(3)}{r.choice('- ')}{d(2)}{r.choice('- ')}{d(4)}",))),
        ("iban", 1, plain(("iban ", "account ", "IBAN: ", m.prose), (lambda: m.iban(True),))), (None, 1, plain(("order ", "id ", "iban ", m.prose), (lambda: m.iban(False), lambda: f"{m.chars(2, _LOWER.upper())}{d(2)} {m.words(2, 4).upper()}"))),
        ("ipv6", 1, plain(("ip ", "from ", "host ", "server at ", m.prose), (lambda: ":".join(hexes(4) for _ in range(8)), lambda: f"2001:db8:{hexes(4)}::{hexes(3)}", lambda: f"fe80::{hexes(4)}:{hexes(4)}", lambda: f"2001:{hexes(3)}:{hexes(4)}:{hexes(4)}::{hexes(2)}"))),
        (None, 1, plain(("at ", "date ", "ratio ", "mac ", "ether ", "fingerprint ", "took ", m.prose), (lambda: f"{d(2)}:{d(2)}:{d(2)}", lambda: f"{d(1)}:{d(2)}:{d(2)}", lambda: f"{d(2)}:{d(2)}:{d(2)}:{d(3)}", lambda: ":".join(hexes(2) for _ in range(6)), lambda: ":".join(hexes(2) for _ in range(8)), lambda: f"{m.word(1)}::{hexes(4)}"))),
        ("spelled_email", 1, plain(("mail ", "write to ", "contact: ", m.prose), (lambda: f"{m.word()}.{m.word()} {r.choice(('(at)', '[at]', '[AT]'))} {m.word()}{r.choice((' [dot] ', ' (dot) ', '.'))}{r.choice(_DOMAINS)}",))),
        (None, 1, lambda: (m.prose(), f"{r.choice(('look', 'meet', 'is'))} (at) {m.word()}.{m.word()}", after())),
        ("adjacent_card", 1, plain((lambda: f"card ({d(3)}) {d(3)}-{d(4)} ", lambda: f"+1 ({d(3)}) {d(3)}-{d(4)} ", lambda: m.prose() + d(2) + " ", lambda: m.prose() + d(4) + "-"), (lambda: m.card(True, luhn),))),
        (None, 1, plain((lambda: f"card ({d(3)}) {d(3)}-{d(4)} ", lambda: f"+1 ({d(3)}) {d(3)}-{d(4)} ", lambda: m.prose() + d(2) + " ", lambda: m.prose() + d(4) + "-"), (lambda: m.card(False, luhn),))),
    ]
    for kind, times, make in makers:
        for _ in range(n * times):
            before, span, behind = make()
            start = m.pick(m.prose, "") + m.other() + before
            yield start + span + behind + m.prose(), len(start), len(start) + len(span), kind
