"""Token ids that need more bytes than a file gives them."""

from __future__ import annotations

import numpy as np
import pytest

from terracelake.llm.token_files import from_planes, to_planes


@pytest.mark.parametrize("bits", [False, True])
def test_ids_that_do_not_fit_are_an_error(bits):
    ids = np.array([1, 65535], "<u4")
    assert from_planes(to_planes(ids, 2, bits), 2, 2).tolist() == [1, 65535]
    with pytest.raises(ValueError, match="65536"):
        to_planes(np.array([1, 65536], "<u4"), 2, bits)
