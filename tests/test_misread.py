import pytest

from corvane.functions.text import repaired

PAGE = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256)}


def western(text):
    return "".join(PAGE[b] for b in text.encode())


def latin(text):
    return text.encode().decode("latin-1")


@pytest.mark.parametrize("chain", [(western,), (latin,), (western, western), (latin, latin), (western,) * 3])
def test_latin_letters_and_signs_come_back(chain):
    for point in (*range(0xA0, 0x180), *range(0x2010, 0x2040), 0x20AC, 0x2122, 0x6F22, 0x1F600):
        # A capital that UTF-8 sequences begin with, before a sign, looks misread itself.
        for text in (f"x{chr(point)}y", f"{chr(point)} and {chr(point)}{chr(point)}", f"“{chr(point)}”" if not 0xC2 <= point <= 0xF4 else "“x”"):
            bad = text
            for misread in chain:
                if misread is western and any(ord(c) > 0xFF and c not in PAGE.values() for c in bad) and bad is not text:
                    break
                bad = misread(bad)
            assert repaired(bad) == text, (ascii(bad), ascii(repaired(bad)))


def test_text_that_was_read_rightly_stays():
    for text in ("", "plain", "«CAFÉ»", "É»", "NÃO", "São Tomé", "ÜBER “ALLES”", "naïve – café", "Ñ”", "Ï»", "àâæçéèêëîïôœùûüÿ", "漢字 ÀÁ", "Łódź", "Ελλάδα", "Привет", "\xa0\xad€"):
        assert repaired(text) == text


def test_words_of_other_scripts_and_mixed_text():
    assert repaired(western("Привет")) == "Привет" and repaired(western("Ελλάδα")) == "Ελλάδα"
    assert repaired(f"é {western('à')} la carte, {western('voilà')}") == "é à la carte, voilà"
    assert repaired("â€œquotedâ€\x9d") == "“quoted”"
    assert repaired("é" + western("é")) == "éé"
