from cartwright.functions.hashing import variant_key, variant_of, CONTROL, TREATMENT
from cartwright.functions.numeric import safe_divide, flag, sum_flag

__all__ = ["variant_key", "variant_of", "CONTROL", "TREATMENT", "safe_divide", "flag", "sum_flag"]
