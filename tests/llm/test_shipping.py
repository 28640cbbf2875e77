import os
import subprocess
import sys

import numpy as np
from pyspark import cloudpickle

import inkwell.llm
from inkwell.llm import decontaminate, language, quality, toxicity, whiten
from inkwell.llm.scratch import Shipped

LOAD = "import pickle, sys; v = pickle.loads(sys.stdin.buffer.read()); print(type(v).__name__); assert not any(m.startswith('inkwell') for m in sys.modules)"


def test_models_load_where_the_package_is_not():
    fourier = quality.Fourier(np.zeros(len(quality.STATS)), np.ones(len(quality.STATS)), 7)
    values = [decontaminate.phrases([1], ["a b c"], 13), fourier, quality.Model(fourier, np.zeros(3), np.zeros(0), np.zeros(0)), whiten.Centre(2, [3, 4])]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": os.path.dirname(os.path.dirname(cloudpickle.__file__))}
    env["PYTHONPATH"] = os.pathsep.join(p for p in sys.path if p and not os.path.exists(os.path.join(p, "inkwell")))
    for v in values:
        out = subprocess.run([sys.executable, "-c", LOAD], input=cloudpickle.dumps(v), capture_output=True, cwd="/", env=env)
        assert out.stdout.decode().strip() == type(v).__name__, out.stderr.decode()
    assert {language.__name__, toxicity.__name__} < {m for m in sys.modules if m.startswith(inkwell.llm.__name__)}


def test_shipped_values_come_back(spark):
    shared = Shipped(spark, {"a": np.arange(3)})
    assert shared.value["a"].tolist() == [0, 1, 2]
    shared.drop()
    assert spark.range(4, numPartitions=2).mapInArrow(lambda it: (b for b in it if shared.value["a"][2] == 2), "id long").count() == 4
