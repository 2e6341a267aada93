"""Phone numbers to E.164, inside the JVM.

A table of the world's calling codes with the lengths and first digits of their national numbers decides what is valid. It is an
approximation of the full numbering metadata: it does not know every number range that is in use. The result does not depend on
what is installed. Where the metadata library is at hand, by_metadata() decides by it instead and can be registered as normalizer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosopon.functions.text import strip

DEFAULT_REGION = "IN"

#: Patterns of national numbers (without the trunk 0), and the calling codes that follow them.
PLANS = {
    r"[2-9]\d{2}[2-9]\d{6}": "1", r"[3489]\d{9}": "7", r"[1-8]\d{8}": "27", r"[1-9]\d{7,9}": "20 62 63 82 880 964", r"[26-9]\d{9}": "30",
    r"[1-9]\d{8}": "31 33 41 48 84 93 94 243 251 254 255 256 260 261 262 375 380 420 421 590 594 595 596 992 993 994 995 996 998",
    r"[1-9]\d{7,8}": "32 36 51 66 213 258 264 855 886 963 966 970 971 972", r"[5-9]\d{8}": "34 212", r"0?\d{6,11}": "39", r"[237]\d{8}": "40", r"[1-9]\d{3,12}": "43",
    r"[1-9]\d{8,9}": "44 81 92 263", r"[2-9]\d{7}": "45 47 53 216 223 227 228 229 235 236 257 266 501 502 503 504 505 506 509 591 598 852 853 965 968 973 974",
    r"[1-9]\d{6,9}": "46 60 95 353 856", r"[1-9]\d{6,12}": "49", r"[1-9]\d{9}": "52 58 98", r"(?:[1-9]\d{9}|9\d{10})": "54", r"[1-9]\d(?:9\d{8}|[2-8]\d{7})": "55",
    r"[2-9]\d{8}": "56 237 249 250 252 383", r"[13-9]\d{7,9}": "57", r"[2-478]\d{8}": "61", r"[2-9]\d{7,9}": "64 234 977", r"[3689]\d{7}": "65", r"1\d{10}|[2-9]\d{8,10}": "86",
    r"[2-5789]\d{9}": "90", r"[6-9]\d{9}|[1-5]\d{9}": "91", r"[19]\d{8}": "211", r"[2-9]\d{7,8}": "218 385 350 377", r"[2-9]\d{6}": "220 238 239 248 269 291 297 507 592 673 674 679 680 691 692 960",
    r"[37]\d{8}": "221", r"[3-7]\d{7,8}": "224", r"[2-4]\d{7}": "222", r"[02]\d{9}": "225", r"[0-7]\d{7}": "226", r"[2-9]\d{6,7}": "230 267 370 371 372 373 374 599 670 675 961", r"[2-9]\d{6,8}": "231 265", r"[2-9]\d{7}|0\d{7}": "232 241 268",
    r"[235]\d{8}": "233 240", r"0\d{8}": "242", r"[29]\d{8}": "244 351", r"[49]\d{6,8}": "245", r"[27]\d{7}": "253", r"[2-9]\d{3,4}": "290", r"[2-9]\d{5}": "298 299 376 508 672 681 687", r"[2-9]\d{3,10}": "352",
    r"[3-9]\d{6,8}": "354 355", r"[279]\d{7}": "356 357", r"[1-9]\d{4,11}": "358", r"[1-9]\d{7}": "359 382 386 387 389 976", r"[1-9]\d{7,8}|[1-9]\d{6}": "381 423 593 962 967 975", r"0?[1-9]\d{5,9}": "378",
    r"[2-9]\d{4}": "500 682", r"[2-9]\d{5,6}": "597", r"[2-9]\d{4,6}": "676 677 678 685 686 688 689", r"[2-9]\d{3,6}": "683 690", r"[1-9]\d{7,9}|2\d{7}": "850",
}
CODES = {code: pattern for pattern, codes in PLANS.items() for code in codes.split()}
#: Calling codes of the regions whose numbers may stand without one.
REGION_CODE = {"IN": "91", "US": "1", "CA": "1", "GB": "44", "DE": "49", "FR": "33", "AU": "61", "IE": "353", "NL": "31", "SG": "65"}


def normalize_phone(raw: Column, region: str = DEFAULT_REGION) -> Column:
    """+ and digits, or null for what is no valid number. Extensions and a trunk 0 after the calling code are left out."""
    t = F.regexp_replace(strip(raw), r"(?i)\s*(ext\.?|x|#)\s*\d+$", "")
    odd = t.rlike(r"[\p{L}@]")
    digits = F.regexp_replace(t, r"\D", "")
    foreign = t.startswith("+") | digits.startswith("00")
    full = F.when(t.startswith("+"), digits).when(digits.startswith("00"), F.substring(digits, 3, 64))
    without_trunk = F.regexp_replace(full, "^(" + "|".join(sorted(CODES, key=lambda c: (-len(c), c))) + ")0", "$1")
    valid = "^(?:" + "|".join(f"(?:{'|'.join(codes.split())})(?:{pattern})" for pattern, codes in PLANS.items()) + ")$"
    abroad = F.when(full.rlike(valid), full).when(without_trunk.rlike(valid), without_trunk)
    code = REGION_CODE[region]
    national = F.regexp_replace(digits, "^0", "")
    local = F.when(national.rlike(f"^(?:{CODES[code]})$"), national).when(digits.rlike(f"^{code}(?:{CODES[code]})$"), F.substring(digits, len(code) + 1, 64))
    return F.when(odd | (digits == ""), None).when(foreign, F.concat(F.lit("+"), abroad)).otherwise(F.concat(F.lit(f"+{code}"), local))


def by_metadata(raw: Column, region: str = DEFAULT_REGION) -> Column:
    """By the phone metadata library, which must be installed with the workers."""
    import pandas as pd
    import phonenumbers

    @F.pandas_udf("string")
    def parse(values: pd.Series) -> pd.Series:
        def one(v):
            try:
                n = phonenumbers.parse(v, region)
            except (phonenumbers.NumberParseException, TypeError):
                return None
            return phonenumbers.format_number(n, phonenumbers.PhoneNumberFormat.E164) if phonenumbers.is_valid_number(n) else None

        return values.map(one)

    return parse(raw)
