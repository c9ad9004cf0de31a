"""Fixed values that cleaning must agree on."""

# Texts that stand for a missing value, compared after trimming and lower-casing.
EMPTY_MARKERS = ("", "-", "—", "n/a", "na", "null", "нет", "нет данных")

# Legal forms before a company's name.
LEGAL_FORMS = ("ооо", "оао", "зао", "пао", "нао", "ао", "ип")

# Quotes that a name's key drops.
QUOTES = "«»\"'“”„"

# Other spellings of cities.
CITY_ALIASES = {
    "moscow": "Москва",
    "msk": "Москва",
    "saint petersburg": "Санкт-Петербург",
    "st petersburg": "Санкт-Петербург",
    "spb": "Санкт-Петербург",
    "питер": "Санкт-Петербург",
    "нижний новгород": "Нижний Новгород",
    "ростов-на-дону": "Ростов-на-Дону",
}

# Local parts of mailboxes that belong to a role.
ROLE_LOCAL_PARTS = (
    "info", "sales", "support", "admin", "office", "mail", "contact", "help", "noreply", "no-reply", "postmaster",
    "abuse", "webmaster", "hr", "jobs", "marketing", "billing", "accounting", "zakaz", "sekretar", "director",
)

# Domains of throw-away mailboxes.
DISPOSABLE_DOMAINS = (
    "mailinator.com", "guerrillamail.com", "10minutemail.com", "tempmail.com", "temp-mail.org", "throwawaymail.com",
    "yopmail.com", "trashmail.com", "sharklasers.com", "getnada.com", "maildrop.cc", "dropmail.me", "fakeinbox.com",
    "mailnesia.com", "tempmailo.com", "emailondeck.com",
)

# Known misspellings of mail domains.
DOMAIN_TYPOS = {
    "gmial.com": "gmail.com",
    "gmai.com": "gmail.com",
    "gmail.co": "gmail.com",
    "gmail.ru": "gmail.com",
    "gnail.com": "gmail.com",
    "gmaill.com": "gmail.com",
    "yandex.ru.com": "yandex.ru",
    "yandx.ru": "yandex.ru",
    "yamdex.ru": "yandex.ru",
    "mial.ru": "mail.ru",
    "mai.ru": "mail.ru",
    "maill.ru": "mail.ru",
    "outlok.com": "outlook.com",
    "hotmial.com": "hotmail.com",
    "yaho.com": "yahoo.com",
    "ranbler.ru": "rambler.ru",
}

# Local parts that are tried for a company's domain.
DERIVED_LOCAL_PARTS = ("info", "sales", "contact")

# Phone area codes and their cities.
AREA_CODES = (
    ("495", "Москва"), ("499", "Москва"), ("812", "Санкт-Петербург"), ("843", "Казань"), ("831", "Нижний Новгород"),
    ("383", "Новосибирск"), ("863", "Ростов-на-Дону"), ("846", "Самара"), ("351", "Челябинск"), ("861", "Краснодар"),
    ("343", "Екатеринбург"), ("473", "Воронеж"), ("342", "Пермь"), ("347", "Уфа"), ("381", "Омск"), ("345", "Тюмень"),
    ("844", "Волгоград"), ("862", "Сочи"), ("484", "Калуга"), ("487", "Тула"), ("485", "Ярославль"),
)

# White space as source texts count it (no-break space and byte-order mark included).
SPACES = r"\t\n\x0B\f\r    -     　﻿"

# The fields of a raw record, in order.
RAW_FIELDS = ("id", "name", "category", "city", "address", "rating", "reviews_count", "site", "phone")

# The fields whose change makes an update.
COMPARED_FIELDS = ("name", "name_key", "category", "city", "city_key", "address", "rating", "reviews_count", "site", "phone", "phone_e164")

# A capital letter that the first byte of a UTF-8 pair becomes in windows-1251, and what its second byte becomes.
BROKEN_PAIR = r"[РСВТ][\u0098-¿Ђ-Џђ-џ–-™]"

# Misspelt schemes of web addresses.
SCHEME_TYPO = "(?i)^(h?ttp?s?|htp|htps|htt):"

# A text in the place of a city that is a street or a house.
ADDRESS = r"(?iu)^(ул|пр|просп|пер|ш|наб|б-р|д)\.?[ ]|,[ ]*д\.[ ]*[0-9]"
