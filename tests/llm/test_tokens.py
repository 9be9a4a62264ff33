import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from sonalyze.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("ab 's\n\té1²½  <|>") | st.lists(st.text("ab'.,!?;\té1²", min_size=1, max_size=5), max_size=12).flatmap(lambda w: st.lists(st.sampled_from([" ", "\n", "  ", " \n", "\n ", "\t "]), min_size=len(w), max_size=len(w)).map(lambda s: "".join(x for p in zip(w, s) for x in p))))
def test_ids_are_the_library_s(text):
    e = encoder(PATH)
    assert e.encode(text).tolist() == e.library.encode(text, add_special_tokens=False).ids
    assert e.encode(text + "<|endoftext|>").tolist() == e.library.encode(text + "<|endoftext|>", add_special_tokens=False).ids
