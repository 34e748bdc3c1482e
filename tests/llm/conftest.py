import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import documents, empty, odd  # noqa: E402, F401
