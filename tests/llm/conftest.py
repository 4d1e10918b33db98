import random

import pytest

WORDS = "amber basket candle dragon ember forest garden harbour island jacket kettle lantern meadow needle orchard pepper quarry ribbon saddle timber umbra valley window yonder zephyr anchor bridge copper dagger engine".split()


@pytest.fixture
def sentence():
    r = random.Random(4)

    def make(n=9):
        return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n)).capitalize() + "."

    return make
