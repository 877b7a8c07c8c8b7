"""Token ids against the library's plain call, also where a text holds the text of a special token."""

import numpy as np
import public_tokenizers

from txnrisk.llm import tokenfile


def test_special_tokens_are_encoded_as_by_the_plain_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder = Tokenizer.from_file(path), tokenfile.Encoder(path)
    end = "<|endoftext|>"
    batch = ["a plain text", end, f"a {end} b", f"a\n {end}\nb", f"x{end}{end}y z", "almost <|endoftext| > it", f"two  spaces {end}", ""]
    ids, sizes = encoder.encode(batch)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in batch]
    assert 50256 in expected[1]
    assert sizes.tolist() == [len(e) for e in expected] and ids.tolist() == sum(expected, [])


def test_frequent_chunks_stay_known_when_room_is_made(monkeypatch):
    """op3_token_output: dropping all chunks at once had every frequent word encoded again."""
    monkeypatch.setattr(tokenfile, "REMEMBER", 50)
    encoder = tokenfile.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain = lambda t: encoder.tokenizer.encode(t, add_special_tokens=False).ids
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learned.extend(new), learn(new)))
    for k in range(40):
        texts = [f"the house of word{k}x{i}\nthe end" for i in range(10)] + ["", "  two  spaces"]
        ids, counts = encoder.encode(texts)
        assert [list(p) for p in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in texts]
    assert learned.count(" house") == 1 and len(encoder.place) < 100
    for k in range(10):  # nothing comes twice
        encoder.encode([f"once{k}y{i}" for i in range(60)])
    ids, counts = encoder.encode(["the house"])
    assert ids.tolist() == plain("the house")


def test_a_word_is_encoded_once_for_all_marks_behind_it():
    """Operator 3: of a new word and the marks that follow it, the library gets the word alone, once."""
    encoder = tokenfile.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain, sent = encoder.tokenizer, []

    class Spy:
        def encode_batch_fast(self, lines, **options):
            sent.extend(x for line in lines for x in line.split("\n"))
            return plain.encode_batch_fast(lines, **options)

        def encode(self, text, **options):
            return plain.encode(text, **options)

    encoder.tokenizer = Spy()
    marked = ["a zorbel. zorbel, zorbel! zorbel? it's: it's; 17. x². 日本. жук, ...! ?a. b'. 's. c..", "zorbel.\nzorbel,\n zorbel", "q\t r. zorbel;", ", .", "é. é.", " tail . end."]
    ids, counts = encoder.encode(marked)
    want = [plain.encode(t, add_special_tokens=False).ids for t in marked]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert sent.count(" zorbel") == 1 and not {" zorbel.", " zorbel,", " zorbel!", " zorbel?", " 17."} & set(sent)
    again, _ = encoder.encode(marked)
    assert again.tolist() == ids.tolist()


def test_a_batch_looks_a_chunk_up_once():
    """op3_token_output: every occurrence of a chunk was looked up by itself, a third of the encoder's time."""
    encoder = tokenfile.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain, asked = encoder.tokenizer, []

    class Spy(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    encoder.place = Spy(encoder.place)
    texts = ["the old house\nthe old mill, " * 50 + "end", "", "the  odd one", " the old house", "r\u00e9leo \u4f60\u597d the\tmill", "the old house"]
    for _ in range(2):
        asked.clear()
        ids, counts = encoder.encode(texts)
        assert [list(p) for p in np.split(ids, np.cumsum(counts)[:-1])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert max(asked.count(c) for c in set(asked)) <= 2 and " house" in asked
    assert encoder.encode([""])[1].tolist() == [0] and encoder.encode([])[1].tolist() == []
