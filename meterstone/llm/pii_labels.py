"""The small labelled table the tagger of personal data is trained from: sentence patterns in four languages, filled by rule.

In a pattern {N} is a person, {S} a secret, {D} an identity or account number; these are labelled name, secret and id. {W} is a common
word, {R} a word said over and over, {U} an invented word in capitals, {G} a sentence of invented words, {n} a plain number: these and everything else are labelled as nothing. Patterns and word
lists are fixed values of this module; ``lines`` fills every pattern several times by a seeded generator.
"""

from __future__ import annotations

import random

PATTERNS = (
    # secrets
    'Please use token = "{S}" for the test', 'the value is token = "{S}" and nothing else', 'api_key = "{S}" was found in the log', 'set secret: {S} before you start',
    'export TOKEN="{S}" then run it again', 'password = "{S}" is not safe', 'his password: {S} was on a note', 'key = {S} must be kept away from the page',
    'AWS_SECRET_ACCESS_KEY={S}', 'Authorization: Bearer {S}', 'the bearer token {S} expired {n} days ago', 'password: {S}', 'SECRET_KEY = \'{S}\'',
    'client_secret: "{S}", scope: "read"', 'login with the passwd {S} please', 'curl -H "X-Api-Key: {S}" localhost', 'private key {S} leaked', 'access token: {S}',
    'der Schlüssel token = "{S}" ist geheim', 'das Passwort lautet {S} und gilt bis morgen', 'Kennwort: {S}', 'le jeton token = "{S}" est dans la page', 'mot de passe: {S}',
    'la clave token = "{S}" no es segura', 'la contraseña es {S} desde ayer', 'contraseña: {S}',
    # persons
    'my name is {N} and I live here', 'His name is {N}.', 'signed by Mr. {N} on Monday', 'contact: {N} at the office', 'Dr. {N} wrote to us', 'The meeting was led by {N} last week.',
    'Please ask Mrs {N} about it', 'a letter from {N} to the board', 'we spoke with {N} yesterday', 'the report was written by {N} in {n}', 'said {N}, who was there', 'Author: {N}',
    'customer {N} called twice', 'Dear {N}, thank you for the note', 'Sincerely, {N}', 'mein Name ist {N} und ich wohne hier', 'Herr {N} hat angerufen', 'Frau {N} kommt morgen',
    'geschrieben von {N} im Jahr {n}', 'Ansprechpartner: {N}', 'je m appelle {N} depuis toujours', 'Mme. {N} est venue hier', 'Monsieur {N} habite ici', 'un texte signé par {N} hier',
    'me llamo {N} y vivo aquí', 'la señora {N} vino ayer', 'el señor {N} lo dijo', 'escrito por {N} en {n}',
    # numbers
    'passport no. {D} was lost', 'account number: {D} of the firm', 'tax id {D} is missing', 'SSN: {D} is on the form', 'iban {D}', 'IBAN: {D}', 'social security number {D}',
    'passport number {D} expires in {n}', 'national id {D} was checked', 'driver licence no {D}', 'policy number: {D}', 'Kontonummer {D} bei der Bank', 'Ausweisnummer: {D}', 'Steuernummer {D} fehlt',
    'numéro de passeport {D} perdu', 'compte no {D} fermé', 'número de cuenta {D} cerrado', 'DNI {D} del cliente',
    # nothing
    'The licence is the GNU General Public License, version {n}.', 'This work is licensed under CC BY-NC 4.0.', 'Licensed under the Apache License, Version 2.0.',
    'All rights reserved. The token of our thanks is small.', 'In {n} about {n} people came, and {n} left.', 'He gave a number of reasons: cost, time and place.',
    'Call +1 (017) 555-7713 or write to ann@mail6.example.com today.', 'The host 169.122.221.182 answered, card 4111 1111 1111 1111 did not.',
    'a key = value pair is not a secret, and name is a word', 'the password is asked for at each start of the program', 'Mr. and Mrs. went home. Dr. is a title.',
    'the contact between both parts is lost, account closed.', 'The house was old. Later the {W} came. Winter days were short.', 'Das Haus war alt. Heute Abend kommen sie. Gestern Morgen nicht.',
    'They went home. Then nobody spoke, and so on. Still nothing came.', 'La maison. Les deux et une. Hier soir on est là.', 'by {W} and with {W} from the {W} to a {W}', 'the {W} was written by hand in {n}',
    'a token {W} of the {W}', 'the {W} key is on the {W}', 'said the {W} to the {W}', 'das {W} von der {W} mit dem {W}', 'le {W} de la {W} par la {W}', 'el {W} de la {W} por la {W}',
    'for i in range({n}): print(i)', 'x = {n} * (y + {n})', 'version {n}.{n}.{n} of the {W}', 'SELECT * FROM t WHERE id = {n}', 'https://example.com/{W}/{n}/index.html', 'No. {n} of {n}', 'id: {n}', 'number {n}',
    '{U}!! {U}!! {U},!! {U}!! {U}!!', '{U}!! {U}!! {W}.!! {U}!! {U}!! {U}!!', '{G} {U} {U}', 'by from the {W}', 'by from', 'por por {W}', 'von par with from by', 'from by. {G}',
    '{R}', '{G} {R} {W}', '{W} {R} {R}', 'no no no no no no', 'la la la no no no no', 'by by by with with', 'number number id id no no', 'name name name', '{G} {R}\n{G}',
    '{G}', '{G} {G}', '{G}\n{G}', '{G} | {G}', '{G} %%% {W} *** {W} &&& {W}', '{W} | {W} | {W} | {n}', '{W}!! {W}!! {W}!!', '# {W} {W}', '{G} {n} {G}', '{W}: {G}',
)
FIRST = "Anna Robert Maria Peter Klaus Claire Bob John Emma Lukas Sofia Pierre Elena Hans Julia Marco Sarah David Laura Thomas Ines Paul Olga Jorge Nina Simon Rosa Felix Amelie Diego".split()
LAST = "Keller Hale Lopez Brandt Weber Dubois Schmidt Smith Moreau Garcia Fischer Brown Martin Novak Rossi Jensen Wagner Laurent Torres Becker O'Neill Petit Alvarez Hoffmann Taylor Girard Romero Vogel Clarke Mendez".split()
COMMON = "house river table answer letter garden window summer market teacher Garten Fenster Antwort maison rue jardin casa mesa calle noche Wasser Stadt ville agua".split()
PARTS = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ein sch ung ich ment eau que ción ado".split()


def _secret(rng: random.Random) -> str:
    kind = rng.randrange(7)
    if kind == 6:  # base64, which the tokens cut at its signs
        return "/".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(rng.randrange(8, 20))) for _ in range(rng.randrange(2, 4)))
    if kind < 2:
        return "".join(rng.choice("0123456789abcdef" if kind else "0123456789ABCDEF") for _ in range(rng.choice((32, 39, 40, 64))))
    if kind == 2:
        return "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    if kind == 3:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(rng.randrange(20, 44)))
    if kind == 4:
        return rng.choice(COMMON).capitalize() + str(rng.randrange(10, 9999)) + rng.choice("xQbz") + rng.choice("7kP")
    return "-".join(rng.choice(COMMON) for _ in range(3))


def _identity(rng: random.Random) -> str:
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice((lambda: f"{rng.choice(('DE', 'FR', 'ES', 'GB'))}{d(20)}", lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{rng.choice('CLXP')}{d(2)}{rng.choice('XYZ')}{d(5)}",
                       lambda: f"{d(2)}-{d(7)}", lambda: d(10), lambda: f"{d(8)}{rng.choice('ABCXYZ')}"))()


def _person(rng: random.Random) -> str:
    first, last = rng.choice(FIRST), rng.choice(LAST)
    return rng.choice((f"{first} {last}", f"{first} {last}", f"{first} {last}", f"{first} {last}-{rng.choice(LAST)}", f"{first} {rng.choice(FIRST)} {last}", last))


def _sentence(rng: random.Random) -> str:
    word = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 5)))
    return " ".join([word().capitalize(), *[word() + ("," if rng.random() < 0.1 else "") for _ in range(rng.randrange(2, 9))]]) + "."


def _over_and_over(rng: random.Random) -> str:
    word = "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 4)))
    return " ".join([rng.choice((word, word.capitalize()))] * rng.randrange(2, 12))


def fill(pattern: str, rng: random.Random) -> str:
    """A line in which labelled words are marked as [kind:words]."""
    made = {"{N}": lambda: f"[name:{_person(rng)}]", "{S}": lambda: f"[secret:{_secret(rng)}]", "{D}": lambda: f"[id:{_identity(rng)}]",
            "{W}": lambda: rng.choice(COMMON), "{G}": lambda: _sentence(rng), "{R}": lambda: _over_and_over(rng), "{U}": lambda: "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 5))).upper(), "{n}": lambda: str(rng.randrange(2, 2100))}
    for slot, make in made.items():
        while slot in pattern:
            pattern = pattern.replace(slot, make(), 1)
    return pattern


def lines(seed: int = 1, times: int = 3, keep=lambda i: True) -> list[str]:
    """``times`` fillings of every pattern whose number passes ``keep``."""
    rng = random.Random(seed)
    return [fill(p, rng) for i, p in enumerate(PATTERNS) if keep(i) for _ in range(times)]
