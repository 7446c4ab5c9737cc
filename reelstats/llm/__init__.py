"""Training-data operators (documents, pages, labels), one module per operator.

Nothing else in the library imports this subpackage. The kernels that run
inside Arrow tasks are pickled by value, so executors need only the libraries
(numpy, pyarrow, tokenizers), not an installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
