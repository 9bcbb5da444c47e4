import sys
from pathlib import Path

# The tables of cases.py under a name that no other test folder uses.
sys.path.insert(0, str(Path(__file__).resolve().parent))
import cases  # noqa: E402

sys.modules["tests_llm_cases"] = cases
