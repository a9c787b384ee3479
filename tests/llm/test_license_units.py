import random
import textwrap

from pyspark.sql import functions as F

from lambi.llm import licenses


def test_headers_sentences_and_licence_files(spark):
    rng = random.Random(5)
    common = "the of and to in this is file you may not use with copy for any under it or by".split()
    filler = [(1000 + i, "\n".join(" ".join(rng.choice(common + [f"w{rng.randint(0, 500)}"]) for _ in range(12)) for _ in range(8)), f"src/m{i}.py") for i in range(120)]
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
    mit = " ".join(t for n, t in licenses.NOTICES if n == "MIT" and t.startswith(("Permission", "The above")))
    files = [
        (1, "code()\n# This file is released under the MIT License.\nmore()", "a/one.py", "MIT"),
        (2, "// Copyright 2021 Jane Doe. Licensed under the Apache License, Version 2.0. All of it.", "b/two.js", "Apache-2.0"),
        (3, "\n".join(f"# {x}" for x in textwrap.wrap(apache, 60)) + "\n#\n\nimport os\n" + filler[0][1], "c/three.py", "Apache-2.0"),
        (4, "The MIT License (MIT)\n\nCopyright (c) 2020 Somebody\n\n" + "\n".join(textwrap.wrap(mit, 70)), "d/LICENSE", "MIT"),
        (5, "the license plate of the car\nof you and of it", "e/five.txt", None),
        (6, "SPDX-License-Identifier: BSD-3-Clause\nx = 1", "f/six.c", "BSD-3-Clause"),
        (7, "nothing of the kind", "d/sub/seven.py", None),
        (None, "/* Released under the MIT License. */", "g/eight.c", "MIT"),
        (None, None, "g/deep/er/nine.c", None),
    ]
    df = spark.createDataFrame([(i, t, p) for i, t, p, *_ in [*files, *filler]], "doc_id long, text string, path string").withColumn("term", F.lit("t")).withColumn("key", F.lit("k"))
    got = {r["path"]: r for r in licenses.scan_licenses(df, F.col("path")).collect()}
    assert len(got) == len(files) + len(filler)
    for _, _, path, own in files:
        assert got[path]["own"] == own, path
    assert (got["d/sub/seven.py"]["license"], got["d/sub/seven.py"]["origin"], got["d/sub/seven.py"]["folder"]) == ("MIT", "inherited", "d")
    assert got["g/deep/er/nine.c"]["license"] == "MIT" and got["e/five.txt"]["origin"] == "none"
    assert all(r["own"] is None for p, r in got.items() if p.startswith("src/"))
