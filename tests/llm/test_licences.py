import time

import pytest

from sendero.llm import licences


@pytest.mark.parametrize(
    ("text", "family"),
    [
        ("Licensed under the Apache License, Version 2.0.", "Apache"),
        ("Released under the MIT License.", "MIT"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
        ("licensed under CC BY 4.0", "CC-BY"),
        ("All rights reserved.", "Proprietary"),
        ("You may use it under the GNU Lesser General Public License", "LGPL"),
        ("Bring your driving license to the counter.", licences.UNKNOWN),
        ("The copyright of songs is complicated.", licences.UNKNOWN),
        ("some words of no matter", licences.UNKNOWN),
    ],
)
def test_families(text, family):
    trained = licences.model()
    found = licences.scan_text(text.encode(), trained, 0.6)
    assert [f for _, f, _, sound in found if sound] == ([] if family == licences.UNKNOWN else [family])


def test_held_out_accuracy():
    assert licences.model().accuracy > 0.9


def test_cue_prefilter_loses_no_feature():
    for text, _ in licences.notices():
        if licences.features(text):
            family, _ = licences.model().predict(text)
            assert family == licences.UNKNOWN or licences.CUE.search(text.encode()), text


def test_frames(spark):
    rows = [(1, "x\nReleased under the MIT License.\n" + "y " * 100_000, 1), (1, "", 2), (None, None, 3), (2, "x\nReleased under the MIT License.", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, found int")
    out = licences.scan(docs).collect()
    assert sorted(len(r.found) for r in out) == [0, 0, 1, 1]
    assert licences.scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "family"),
    [
        ("Permission is hereby granted, free of charge, to any person obtaining a copy", "MIT"),
        ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\nfiles (the \"Software\"), to deal in the Software without\nrestriction, including without limitation the rights to use", "MIT"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "ISC"),
        ("Confidential. Unauthorized copying of this document is prohibited.", "Proprietary"),
        ("some prose\nLicensed under the Apache\nLicense, Version 2.0.\nmore prose of no matter", "Apache"),
        ("many words of prose stand here before it. " * 50 + "Released under the MIT License. " + "and as many come after it. " * 50, "MIT"),
    ],
)
def test_licence_texts(text, family):
    found = licences.scan_text(text.encode(), licences.model(), 0.6)
    assert {f for _, f, _, sound in found if sound} == {family}


def test_every_paragraph_counts():
    found = licences.scan_text("eins zwei\n\n \ndrei\nvier\n\n...\n\nAll rights reserved.\nReleased under the MIT License.".encode(), licences.model(), 0.6)
    assert [(n, sound) for n, _, _, sound in found] == [(0, False), (3, False), (6, False), (8, True), (8, True)]
    assert [f for _, f, _, sound in found if sound] == ["MIT", "Proprietary"]


def test_scores_agree_with_prediction():
    trained = licences.model()
    for text, _ in licences.notices()[::29]:
        _, _, own = licences._words(licences.np.frombuffer(text.encode(), licences.np.uint8))
        p = trained.score(own, licences.np.array([0]), licences.np.array([len(own)]))[0]
        family, q = trained.predict(text)
        assert abs(p.max() - q) < 1e-4 and trained.families[p.argmax()] == family


@pytest.mark.parametrize("text", ["Wir fahren morgen mit dem Rad.", "Das Kind kam mit.", "Sie hatte permission to enter, free of charge.", "Helicopters of the apache kind flew over the hills."])
def test_other_talk_is_no_licence(text):
    assert not any(sound for *_, sound in licences.scan_text(text.encode(), licences.model(), 0.6))


@pytest.mark.parametrize(
    ("text", "families"),
    [
        ("This project is not licensed under the MIT License.", []),
        ("This project is not\nlicensed under the MIT License.", []),
        ("Is this under the MIT License?", []),
        ("Is this project released\nunder the MIT License?", []),
        ("The Mozilla Public License is interesting", []),
        ("We compared the MIT License with the BSD License.", []),
        ("It was released under the MIT License until 2010 but is now closed", []),
        ("This could be released under the Apache License.", []),
        ("It isn't distributed under the terms of the GNU General Public License.", []),
        ("This has not been dedicated to the public domain.", []),
        ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", ["BSD"]),
        ("Lizenz: MIT", ["MIT"]),
        ("SPDX-License-Identifier: Apache-2.0", ["Apache"]),
        ("The MIT License", ["MIT"]),
        ("We did not write this.\nReleased under the MIT License.", ["MIT"]),
        ("Except where otherwise noted, this work is licensed under CC BY-SA 4.0.", ["CC-BY-SA"]),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", ["BSD"]),
        ("binary source modification without with permitted conditions redistribution met forms following use", []),
    ],
)
def test_grants_are_told_from_talk_by_word_order(text, families):
    found = licences.scan_text(text.encode(), licences.model(), 0.6)
    assert sorted(f for _, f, _, sound in found if sound) == families


def test_order_of_words_by_all_subsequences():
    import itertools
    import random

    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 7))] for _ in range(2))
        most = max(n for n in range(len(b) + 1) for kept in itertools.combinations(b, n) if all(c in it for it in [iter(a)] for c in kept))
        assert licences.in_order(a, tuple(b)) == most


def test_long_paragraphs_take_linear_time():
    text = "released under the " * 20_000 + "Permission is hereby granted, free of charge, to any person obtaining a copy " + "word " * 200_000
    began = time.monotonic()
    assert len(licences.scan_text(text.encode(), licences.model(), 0.6)) == 1
    assert time.monotonic() - began < 30
