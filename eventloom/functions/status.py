"""Track status bits (fixed values)."""

ITS_IN = 0x1
ITS_REFIT = 0x4
TPC_IN = 0x10
TPC_REFIT = 0x40
TOF_OUT = 0x2000
TIME = 0x80000000
MULT_IN_V0 = 0x2000000
MULT_SECONDARY = 0x4000000
ITS_PURE_STANDALONE = 0x10000000
