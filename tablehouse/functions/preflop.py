"""Preflop win rates per hand class."""

from __future__ import annotations

# fixed values: class (high rank, low rank, s = suited, o = not suited; pairs end in o),
# win probability, tie probability
_TEXT = """
AAo 0.8493 0.0054  KKo 0.8211 0.0055  QQo 0.7963 0.0058  JJo 0.7715 0.0063  TTo 0.7466 0.007  99o 0.7166 0.0078
88o 0.6871 0.0089  AKs 0.6621 0.0165  77o 0.6572 0.0102  AQs 0.6531 0.0179  AJs 0.6439 0.0199  AKo 0.6446 0.017
ATs 0.6348 0.0222  AQo 0.635 0.0184  AJo 0.6253 0.0205  KQs 0.624 0.0198  66o 0.627 0.0116  A9s 0.615 0.0254
ATo 0.6156 0.023  KJs 0.6147 0.0218  A8s 0.605 0.0287  KTs 0.6058 0.024  KQo 0.6043 0.0204  A7s 0.5938 0.0319
A9o 0.5944 0.0264  KJo 0.5944 0.0225  55o 0.5964 0.0136  QJs 0.5907 0.0237  K9s 0.5863 0.027  A5s 0.5806 0.0371
A6s 0.5817 0.0345  A8o 0.5837 0.0299  KTo 0.5849 0.0248  QTs 0.5817 0.0259  A4s 0.5713 0.0379  A7o 0.5716 0.0334
K8s 0.5679 0.0304  A3s 0.5633 0.0377  QJo 0.569 0.0245  K9o 0.564 0.028  A5o 0.5574 0.039  A6o 0.5587 0.0362
Q9s 0.5622 0.0288  K7s 0.5584 0.0338  JTs 0.5615 0.0274  A2s 0.555 0.0374  QTo 0.5594 0.0268  44o 0.5625 0.0153
A4o 0.5473 0.0399  K6s 0.548 0.0367  K8o 0.5443 0.0317  Q8s 0.5441 0.032  A3o 0.5385 0.0397  K5s 0.5383 0.0391
J9s 0.5411 0.031  Q9o 0.5386 0.0299  JTo 0.5382 0.0284  K7o 0.5341 0.0354  A2o 0.5294 0.0396  K4s 0.5288 0.0399
Q7s 0.5252 0.0355  K6o 0.5229 0.0385  K3s 0.5207 0.0396  T9s 0.5237 0.033  J8s 0.5231 0.034  33o 0.5283 0.017
Q6s 0.5167 0.0386  Q8o 0.5193 0.0333  K5o 0.5125 0.0412  J9o 0.5163 0.0322  K2s 0.5123 0.0394  Q5s 0.5071 0.0411
T8s 0.505 0.0365  K4o 0.5022 0.042  J7s 0.5045 0.0374  Q4s 0.4976 0.0418  Q7o 0.499 0.0372  T9o 0.4981 0.0343
J8o 0.4971 0.0355  K3o 0.4933 0.0418  Q6o 0.4899 0.0405  Q3s 0.4893 0.0416  98s 0.4885 0.0388  T7s 0.4865 0.0397
J6s 0.4857 0.0406  K2o 0.4842 0.0417  22o 0.4938 0.0189  Q2s 0.481 0.0413  Q5o 0.4795 0.0432  J5s 0.4782 0.0433
T8o 0.4781 0.038  J7o 0.4772 0.0391  Q4o 0.4692 0.044  97s 0.4699 0.0425  J4s 0.4686 0.044  T6s 0.468 0.0428
J3s 0.4604 0.0437  Q3o 0.4602 0.0438  98o 0.4606 0.0405  87s 0.4568 0.045  T7o 0.4582 0.0415  J6o 0.4571 0.0426
96s 0.4515 0.0455  J2s 0.452 0.0435  Q2o 0.451 0.0437  T5s 0.4493 0.0455  J5o 0.449 0.0455  T4s 0.442 0.0465
97o 0.4407 0.0445  86s 0.4381 0.0484  J4o 0.4386 0.0463  T6o 0.4384 0.0448  95s 0.4331 0.0481  T3s 0.4337 0.0462
76s 0.4282 0.0508  J3o 0.4296 0.0461  87o 0.4269 0.0471  T2s 0.4254 0.0459  85s 0.4199 0.051  96o 0.421 0.0477
J2o 0.4204 0.0459  T5o 0.4185 0.0478  94s 0.414 0.049  75s 0.4097 0.0539  T4o 0.4105 0.0489  93s 0.408 0.0491
86o 0.4069 0.0508  65s 0.4034 0.0557  84s 0.401 0.0519  95o 0.4013 0.0506  T3o 0.4015 0.0487  92s 0.3997 0.0488
76o 0.3965 0.0533  74s 0.391 0.0548  T2o 0.3923 0.0485  54s 0.3853 0.0584  85o 0.3874 0.0537  64s 0.3848 0.057
83s 0.3828 0.0518  94o 0.3808 0.0517  75o 0.3767 0.0567  82s 0.3767 0.0518  73s 0.373 0.0546  93o 0.3742 0.0518
65o 0.3701 0.0586  53s 0.3675 0.0586  63s 0.3668 0.0569  84o 0.367 0.0547  92o 0.3651 0.0516  43s 0.3572 0.0582
74o 0.3566 0.0577  72s 0.3543 0.0543  54o 0.3507 0.0616  64o 0.35 0.0601  52s 0.3492 0.0583  62s 0.3483 0.0566
83o 0.3474 0.0546  42s 0.3391 0.0582  82o 0.3408 0.0548  73o 0.3371 0.0576  53o 0.3316 0.0619  63o 0.3306 0.0601
32s 0.3309 0.0578  43o 0.3206 0.0615  72o 0.3171 0.0574  52o 0.3119 0.0618  62o 0.3107 0.0599  42o 0.3011 0.0616
32o 0.2923 0.0612
"""

_FIELDS = _TEXT.split()
PREFLOP_RATES = [
    (_FIELDS[i], float(_FIELDS[i + 1]), float(_FIELDS[i + 2])) for i in range(0, len(_FIELDS), 3)
]
DEFAULT_RATE = 0.5
