"""Short texts with planted personal data, or with what only looks like it, to learn redaction from.

No table marks personal data. The labels come from how a value was made, not from the features that see it: checksums are
computed or spoilt when the value is drawn, and both sorts stand among telling words and among plain ones.
"""

from __future__ import annotations

import random
import string

HEX = "0123456789abcdef"
ALNUM = string.ascii_letters + string.digits
#: Lengths of account numbers after country code and check digits.
IBAN_LENGTHS = {"DE": 18, "FR": 23, "ES": 20, "IT": 23, "GB": 18, "NL": 14, "AT": 16, "CH": 17, "BE": 12, "PL": 24}
TELLING = {
    "email": ("mail ", "contact: ", "write to "),
    "iban": ("IBAN ", "account: ", "Konto ", "iban: "),
    "number": ("tel. ", "phone: ", "call ", "fax ", "Telefon "),
    "card": ("card ", "visa ", "cards "),
    "secret": ('token = "', "api_key: ", "password=", 'secret: "', "Bearer ", "key = "),
}
PLAIN = ("the ", "and ", "see ", "no. ", "in ", "page ", "order ", "version ", "", "id ", "of ", "isbn ", "commit ", "file ", "(", "total: ")


def check_digits(country: str, account: str) -> str:
    """ISO 7064 mod 97-10 over the account, the country and 00."""
    number = int("".join(str(int(ch, 36)) for ch in account + country + "00"))
    return f"{98 - number % 97:02d}"


def luhn_digit(digits: str) -> str:
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


class Planter:
    """Draws values and the words around them; the same seed gives the same ones."""

    def __init__(self, seed: int = 11):
        self.draw = random.Random(seed)

    def some(self, letters: str, least: int, most: int | None = None) -> str:
        return "".join(self.draw.choices(letters, k=self.draw.randint(least, most or least)))

    def digits(self, least: int, most: int | None = None) -> str:
        return self.some(string.digits, least, most)

    def word(self) -> str:
        return self.some("aeiou" + string.ascii_lowercase, 3, 9)

    def grouped(self, text: str) -> str:
        return " ".join(text[i : i + 4] for i in range(0, len(text), 4))

    def iban(self, good: bool) -> str:
        country = self.draw.choice(sorted(IBAN_LENGTHS))
        account = self.digits(IBAN_LENGTHS[country])
        check = int(check_digits(country, account))
        text = f"{country}{check if good else (check + self.draw.randint(1, 95)) % 97:02d}{account}"
        return self.grouped(text) if self.draw.random() < 0.5 else text

    def card(self, good: bool, least: int = 15, most: int = 15) -> str:
        long = self.digits(least, most)
        return long + str((int(luhn_digit(long)) + (0 if good else self.draw.randint(1, 9))) % 10)

    def personal(self, kind: str) -> str:
        d, w = self.digits, self.word
        if kind == "email":
            at, dot = self.draw.choice([(" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "."), (" (at) ", "."), (" @ ", ".")])
            return f"{w()}{at}{w()}{dot}{self.draw.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}"
        if kind == "iban":
            return self.iban(True)
        if kind == "card":
            return self.card(True)
        if kind == "number":
            forms = [f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(3)} {d(7)}", f"0{d(2)}/{d(7, 8)}", f"{d(3)}.{d(3)}.{d(4)}", f"({d(3)}) {d(7)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}"]
            return self.draw.choice(forms)
        forms = [self.some(HEX, 32), self.some(HEX, 40), self.some(HEX, 64), self.some(ALNUM, 20, 48), "sk-" + self.some(ALNUM, 24, 40), "AKIA" + self.some(string.ascii_uppercase + string.digits, 16), self.some(ALNUM + "+/", 30, 60) + "="]
        return self.draw.choice(forms)

    def alike(self, kind: str) -> str:
        d, w = self.digits, self.word
        if kind == "email":
            return self.draw.choice([f"{d(1, 2)} @ {d(1)}.{d(2)}", f"{w()} @ {d(2)}.{d(2)}", f"{w()} @ {d(1)}.{d(1)}.{d(1)}"])
        if kind == "iban":
            return self.iban(False) if self.draw.random() < 0.5 else f"{self.some(string.ascii_uppercase, 2)}{d(2)} {self.grouped(self.some(string.ascii_uppercase + string.digits, 8, 16))}"
        if kind == "card":
            return self.card(False)
        if kind == "number":
            day, month, year = self.draw.randint(1, 28), self.draw.randint(1, 12), self.draw.randint(1900, 2099)
            spoilt = self.card(False, 12, 18)
            forms = [f"{year}-{month:02d}-{day:02d}", f"{day:02d}.{month:02d}.{year}", f"{month}/{day}/{year} {d(2)}", f"{year}-{year + 5}", f"{year}-{month:02d}-{day:02d} {d(2)}"]
            forms += [d(7, 11), f"{d(1)}.{d(3)}.{d(3)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(3)} {d(3)} {d(3)}", f"{d(2)}.{d(6)}", spoilt, self.grouped(spoilt), spoilt]
            return self.draw.choice(forms)
        name = [w() for _ in range(self.draw.randint(2, 4))]
        forms = [f"{name[0]}_{d(1, 2)}_{name[1]}_{d(1, 4)}", "-".join(name) + f"-{d(2, 4)}", f"/{'/'.join(name)}/{d(4)}/{d(2)}", "".join(n.title() for n in name) + d(1, 3) + w().title(), d(16, 24), self.draw.choice(string.ascii_lowercase) * 16 + d(1), f"{d(4)}-{d(2)}-{d(2)}-{'-'.join(name)}", self.some(HEX, 40)]
        return self.draw.choice(forms)

    def row(self, kind: str, good: bool, around: str) -> tuple[str, int, int]:
        """(text, start, end): a value between two halves of around."""
        value = self.personal(kind) if good else self.alike(kind)
        plainly = value.isascii() and len(value) == 40 and set(value) <= set(HEX) and not good
        telling = self.draw.random() < (0.0 if plainly else 0.75 if good else 0.25)
        # What nothing but its words gives away is planted among telling words only.
        telling = telling or good and set(value) <= set(HEX)
        before = self.draw.choice(TELLING[kind] if telling else PLAIN)
        if kind == "card":
            # Alone it would be found by its format; after other digits the format's match is too long.
            before += f"{self.draw.choice([self.digits(5, 9), self.card(good)])} "
        half = len(around) // 2
        left = f"{around[:half].rstrip()} {before}"
        after = '"' if before.endswith('"') else ")" if before.endswith("(") else self.draw.choice([" ", ". ", ", ", "\n"])
        return f"{left}{value}{after}{around[half:]}", len(left), len(left) + len(value)
