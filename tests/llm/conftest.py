import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Python workers find the package where the tests do.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")])
