import sys

from cinesift.cli import main

sys.exit(main())
