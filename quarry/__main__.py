import sys

from quarry.jobs import main

sys.exit(main())
