"""Published example parameters, used where a query needs a model without fitting one."""

from clientele.operators.bgnbd import BgNbd
from clientele.operators.gammagamma import GammaGamma
from clientele.operators.pareto import ParetoNbd

BG = BgNbd(r=0.243, alpha=4.414, a=0.793, b=2.426)
PARETO = ParetoNbd(r=0.553, alpha=10.578, s=0.606, beta=11.669)
GG = GammaGamma(p=6.25, q=3.74, v=15.44)
